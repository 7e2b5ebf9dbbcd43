"""Operators for preparing training data: sharding, cleaning, filtering, packing and search."""
