"""Column functions: NULL in, NULL out, no Python workers."""
