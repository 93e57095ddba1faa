"""Column functions: text, geometry, statistics."""
