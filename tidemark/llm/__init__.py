"""Operators for preparing training text, each on DataFrames; nothing outside imports them."""
