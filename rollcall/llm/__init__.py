"""Operators that prepare text for training: ten operators, their queries and the corpus pipeline's parts.

Nothing else in the library imports this package.
"""
