"""Relational operators of the lexical model: DataFrames in, DataFrame out."""
