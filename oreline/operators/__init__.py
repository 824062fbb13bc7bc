"""Table operators: audit, profile, dedup, split, stage counts, dense keys."""
