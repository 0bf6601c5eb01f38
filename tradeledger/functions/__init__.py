"""Column expressions shared by all operators. No Python UDFs."""
