"""Operators that prepare training text, their queries and their SQL."""
