"""Column expressions and the row-wise transforms built from them."""
