"""Table operators: DataFrames in, DataFrames out, nothing collected."""
