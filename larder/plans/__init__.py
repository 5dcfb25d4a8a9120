"""Operators wired together, and the queries built on them."""
