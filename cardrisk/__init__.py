"""Card-transaction risk analytics on Spark DataFrames."""
