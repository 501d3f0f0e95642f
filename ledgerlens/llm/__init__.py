"""Operators for preparing training data: one module per operator.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; ``queries`` registers the thin ``opN_<name>`` queries.
"""
