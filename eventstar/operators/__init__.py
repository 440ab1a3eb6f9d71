"""Reusable operators: validation, keyed first-wins, integrity checks."""
