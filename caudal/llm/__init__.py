"""Operators for preparing training data, each with a query over the given tables.

Nothing else in the library imports this subpackage.
"""
