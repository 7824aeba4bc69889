"""Operators for building training corpora: one module per operator.

Each operator takes a DataFrame with an id and a text column, selects those
two under its own names first (extra columns, whatever their names, never
clash) and returns a DataFrame. ``queries`` registers one query per operator.
"""
