"""Training-data operators on DataFrames.  Nothing outside this package imports it."""
