"""Readers that give DataFrames with fixed schemas."""
