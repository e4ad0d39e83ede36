"""A PySpark engine for encyclopedia dumps: search, fetch, extract and publish, all as DataFrames."""
