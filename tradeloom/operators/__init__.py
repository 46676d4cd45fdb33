"""Table operators: DataFrames in, DataFrames out, nothing executed early."""
