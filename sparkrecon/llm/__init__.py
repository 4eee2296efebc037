"""Operators for preparing language-model training data, each by one named method.

Nothing else in the library imports this package. ``queries.py`` registers one query per operator.
"""
