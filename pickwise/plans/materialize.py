"""Cut lineage of small tables that many branches of a plan reuse.

Representative days and the services running on them are tiny (bundles x
days x services) but feed every operator; without a cut, each branch
re-runs their chain of small shuffles. ``materialize`` writes Parquet into
the cluster's shared ``spark.checkpoint.dir`` and reads it back, so a lost
executor recomputes nothing and loses nothing, later scans are pruned and
filtered like any stored table, and the planner knows the table's measured
size in bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pickwise.session import scratch_dir


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder, removed when the application ends."""
    path = scratch_dir(spark, f"{name}-")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """``df`` as a stored table. Runs a job.

    No join hint is needed (or given) on the result: the planner broadcasts it
    only while the bytes written are under ``spark.sql.autoBroadcastJoinThreshold``
    and otherwise shuffles, with AQE skew splitting.
    """
    path = scratch_folder(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
