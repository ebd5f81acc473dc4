"""tallyloom: warehouse loading and conversion analytics on Spark DataFrames."""
