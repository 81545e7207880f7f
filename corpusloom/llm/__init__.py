"""Operators for pipelines that make training data; nothing else in the library imports them."""
