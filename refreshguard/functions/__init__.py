"""Column functions: month arithmetic, ratios and violation predicates."""
