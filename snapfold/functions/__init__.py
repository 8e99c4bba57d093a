"""Column -> Column functions: cleaning rules, exact means, row fingerprints."""
