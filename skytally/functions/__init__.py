"""Column expressions. All are built-in functions, so they stay in generated code."""
