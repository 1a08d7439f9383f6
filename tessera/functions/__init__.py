"""Column-expression helpers: missing-value rules and array maths."""
