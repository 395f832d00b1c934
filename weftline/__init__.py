"""A sequence-graph and training-data engine on Spark DataFrames."""
