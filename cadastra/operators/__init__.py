"""Relational operators: spatial joins, dissolving, slope."""
