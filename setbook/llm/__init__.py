"""Operators of a training-data pipeline over a table of documents.

Ten operators, one module each, plus helpers; nothing outside this
subpackage imports it.  ``registry.queries()`` holds the thin ``opN_*``
queries, ``registry.oracle_sql()`` the SQL where SQL can express them.
"""
