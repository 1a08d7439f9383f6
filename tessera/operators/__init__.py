"""Batch operators: frame ops, profiles, two-level ordering, preparation,
metrics and models."""
