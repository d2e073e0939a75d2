"""Operators of a training-data pipeline over the text, page and vector tables."""
