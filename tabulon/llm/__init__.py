"""Operators of a training-data pipeline over text tables.  Nothing outside this package imports it."""
