"""Plans of the warehouse engine."""
