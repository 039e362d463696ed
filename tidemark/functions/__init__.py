"""Column functions: names, type inference, instants, nested values."""
