"""Operators for preparing training text, one module each, and their queries.

Nothing else in the package imports this subpackage. Every operator takes
DataFrames and returns a DataFrame; the registered queries
(:mod:`adcredit.llm.queries`) only choose tables, production parameters and
digest columns.
"""
