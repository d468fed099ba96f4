"""Column functions: everything here is a native expression, no Python runs per row."""
