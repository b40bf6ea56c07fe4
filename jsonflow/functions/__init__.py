"""Column expressions over parsed messages."""
