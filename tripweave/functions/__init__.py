"""Column expressions and fixed label tables shared by the operators."""
