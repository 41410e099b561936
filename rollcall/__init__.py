"""rollcall: workforce time-and-presence analytics on Spark DataFrames."""
