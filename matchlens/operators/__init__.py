"""Validation, expansion, aggregation and window operators on match DataFrames."""
