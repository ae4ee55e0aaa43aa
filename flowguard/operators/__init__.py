"""Relational and ML operators; each is a function over DataFrames."""
