"""Column-expression library (built-in functions only, no UDFs)."""
