"""Relational operators, star schemas, data quality and change capture."""
