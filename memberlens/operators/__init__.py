"""Product-level operators: DataFrames in, a lazy DataFrame out."""
