"""Analysis operators: DataFrames in, DataFrame out."""
