"""Operators: parsing, model building, integrity checks, appends."""
