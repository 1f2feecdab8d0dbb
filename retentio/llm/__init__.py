"""Operators for large training-data pipelines over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``registry`` names the queries and their SQL.
"""
