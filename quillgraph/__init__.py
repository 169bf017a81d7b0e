"""Content knowledge-graph analytics on Spark DataFrames."""
