"""Sources of the warehouse engine."""
