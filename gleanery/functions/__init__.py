"""Column builders. Every function here returns a Column made of built-in expressions."""
