"""Operators: split, merge, repair, dimensions, landing, dedupe, checks."""
