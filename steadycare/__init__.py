"""Care-retention analytics on Spark DataFrames."""
