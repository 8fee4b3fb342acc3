"""Column functions: text normalization and string similarity."""
