"""Column expressions shared by the operators (I1-I14): exact averages,
null-safe change tests, date/time keys, hour buckets, JSON fields."""
