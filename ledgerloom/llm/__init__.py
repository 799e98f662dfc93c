"""Operators for preparing training text, each a function from DataFrame to DataFrame."""
