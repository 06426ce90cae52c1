"""voltide: trade-volume analytics on Spark DataFrames."""
