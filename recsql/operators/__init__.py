"""Table-level operators: cleaning, features, enrichment, splits, metrics,
evaluation, strata, significance, experiments and catalogue queries."""
