"""A versioned-record mirror engine on Spark DataFrames."""
