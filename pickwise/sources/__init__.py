"""Sources and sinks: bundle tables (Parquet), GTFS text feeds, the star-schema
test mapping, and writers."""
