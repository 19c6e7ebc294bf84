"""Composed layer steps: raw -> Bronze, Bronze -> Silver, Silver repair."""
