"""obsledger: longitudinal observation analytics on Spark DataFrames."""
