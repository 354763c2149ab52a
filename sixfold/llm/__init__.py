"""Operators for building language-model training data, their queries and their SQL. Nothing outside imports this package."""
