"""Operators for large training corpora.

Nothing outside this subpackage imports it; ``cartwheel/llm/queries.py`` holds the registered queries and
their SQL.
"""
