"""Operators over training text: one module for each, queries and SQL in ``queries``.

Nothing outside this package imports it. Every operator reads only the columns it names, so
extra columns of any name are ignored.
"""
