"""Operators of a training-data pipeline over document and embedding tables.

Each module holds one operator with its own interface; ``queries`` holds the
registered query of each. Nothing outside this package imports it.
"""
