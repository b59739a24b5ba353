"""ledgerline: usage-billing analytics on Spark DataFrames."""
