"""Operators for large text collections. Nothing outside this package imports it."""
