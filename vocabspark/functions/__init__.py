"""Column functions: regex classes, splits, byte alphabet, normalization."""
