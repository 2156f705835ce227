"""Operators for preparing training text: ten operators, their queries and their SQL checks."""
