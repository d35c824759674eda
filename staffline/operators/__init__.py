"""DataFrame operators (pure functions over DataFrames)."""
