"""Column functions: text, geometry on nested arrays, zones."""
