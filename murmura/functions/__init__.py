"""Column functions: built-in expressions only, but for the exact sequence ratio."""
