"""Column-to-column helpers, all built from native expressions."""
