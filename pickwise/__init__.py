"""pickwise: compare published versions ("picks") of a transit schedule with Spark.

Every operator takes DataFrames and returns a DataFrame. All tables carry a
``bundle`` column (the schedule version), so one plan covers every bundle at
once; no operator collects data to the driver.
"""

__version__ = "0.1.0"
