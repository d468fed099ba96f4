"""Conference-call transcript analytics on Spark DataFrames."""
