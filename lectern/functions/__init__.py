"""Column expressions over text."""
