"""Operators for preparing training text at cluster scale.

Nothing else in the library imports this package. Each module holds one
operator with a general interface; ``queries`` derives the registered results.
"""
