"""Operators for preparing training data. Nothing else in the library imports this package.

Every operator takes and returns DataFrames. Columns it does not use are kept where it returns whole
documents; a result column replaces an input column of the same name.
"""
