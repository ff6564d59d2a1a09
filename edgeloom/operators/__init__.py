"""Operators on the data model; each takes and returns model objects or DataFrames."""
