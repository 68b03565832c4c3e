"""Employee sport-benefit analytics on Spark DataFrames."""
