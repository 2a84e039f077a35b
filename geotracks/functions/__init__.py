"""Column builders made of built-in expressions."""
