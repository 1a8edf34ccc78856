"""Operators for preparing training text: ten operators, their queries and SQL.

Nothing else in the library imports this package.
"""
