"""Column builders: scalar functions and row hashes."""
