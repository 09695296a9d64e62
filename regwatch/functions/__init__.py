"""Column functions, all built from native expressions."""
