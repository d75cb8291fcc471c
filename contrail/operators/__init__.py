"""The models: every operator takes and returns DataFrames."""
