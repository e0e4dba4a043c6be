"""Operators for preparing language-model training data, and their named queries.

Nothing else in the package imports this subpackage.
"""
