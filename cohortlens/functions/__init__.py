"""Column-level expressions: labels, guards, metric formulas, reproducible draws."""
