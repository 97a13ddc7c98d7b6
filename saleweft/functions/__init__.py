"""Column expressions. All stay inside generated code; none is a UDF."""
