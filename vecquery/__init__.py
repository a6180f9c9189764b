"""vecquery: retrieval analytics on Spark DataFrames."""
