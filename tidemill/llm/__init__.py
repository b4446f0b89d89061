"""Operators for preparing training data at scale.

Every operator is a function of DataFrames with column names as parameters.
It selects the columns it needs, so further columns of the input, whatever
their names, neither clash nor get lost: results carry the id and new columns.
Nothing else in the library imports this subpackage.
"""
