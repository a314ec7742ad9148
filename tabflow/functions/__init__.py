"""Column expressions: casts, label maps, name clean-up, flags, hash buckets."""
