"""Plan building blocks: staging, ordering, skew-safe joins, exact quantiles."""
