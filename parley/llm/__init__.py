"""Operators for training-data pipelines over document tables (one module per operator).

Nothing else in the library imports this package; it may import the library's general helpers.
"""
