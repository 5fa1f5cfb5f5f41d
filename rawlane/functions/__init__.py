"""Column expressions. Everything here is a built-in Spark expression, so it stays inside generated code."""
