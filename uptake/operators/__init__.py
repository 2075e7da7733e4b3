"""Adoption-analytics operators: each returns a lazy DataFrame."""
