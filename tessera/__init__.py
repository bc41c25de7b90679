"""Repository analytics and nested-data processing on Spark DataFrames."""
