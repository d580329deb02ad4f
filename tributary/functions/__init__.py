"""Column expressions: null policy, ratios, row statistics, recency, p-values."""
