"""Operators of the warehouse engine."""
