"""Early-payment discount analytics on Spark DataFrames."""
