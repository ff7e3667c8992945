"""Functions of the warehouse engine."""
