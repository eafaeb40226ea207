"""Relational building blocks."""
