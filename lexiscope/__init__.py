"""Text screening and trend analytics on Spark DataFrames."""
