"""Operators for large-scale preparation of training text.

Nothing outside this folder imports it. Every operator takes DataFrames and
returns DataFrames; ``queries.py`` registers one query per operator.
"""
