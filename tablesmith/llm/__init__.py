"""Operators for preparing training data: filters, near-duplicate joins,
tokenization, mixing and search. Nothing outside this package imports it."""
