"""Relational operators of the silver and gold layers and the data-quality checks."""
