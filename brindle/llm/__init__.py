"""Operators for preparing training corpora.

Every operator takes and returns DataFrames.  Nothing outside this subpackage imports it.
"""
