"""Column expressions and distributed statistics shared by the operators."""
