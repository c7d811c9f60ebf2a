"""Card loyalty scoring on Spark DataFrames."""
