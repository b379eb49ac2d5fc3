"""Column expressions: labels, buckets, date keys, ratios, measure rules."""
