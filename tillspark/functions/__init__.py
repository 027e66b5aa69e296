"""Column-level building blocks. All are built-in expressions; there are no UDFs."""
