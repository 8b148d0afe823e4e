"""Column functions; all but the sequence matcher are built-in expressions."""
