"""Operators for training data: each module has one operator, ``queries`` registers them."""
