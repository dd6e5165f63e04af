"""Change data to star schema, on Spark DataFrames."""
