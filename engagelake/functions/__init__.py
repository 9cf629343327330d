"""Column expressions (built-in Spark functions only): casts, parsing, hashing, exact sums."""
