"""Streaming of the warehouse engine."""
