"""The four screening stages and the final record, each from DataFrames to DataFrames."""
