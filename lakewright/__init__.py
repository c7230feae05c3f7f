"""Program-knowledge analytics on Spark DataFrames."""
