"""Tables of each layer as functions from DataFrames to a DataFrame, and the jobs that build them."""
