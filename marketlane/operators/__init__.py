"""Relational operators of the retail domain."""
