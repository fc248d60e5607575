"""Operators: each takes a Warehouse (and parameters) and returns a lazy DataFrame."""
