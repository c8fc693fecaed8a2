"""Operators that prepare training data for language models.

Self-contained: the operators, their named queries (``queries.py``) and SQL
live here, and no other part of the library imports this subpackage.
"""
