"""Column functions: normalization, tokens, address parsing, string similarity."""
