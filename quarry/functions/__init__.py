"""Column functions and type names."""
