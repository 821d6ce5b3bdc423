"""Relational operators: metric pyramids, merges, address products, geocoding."""
