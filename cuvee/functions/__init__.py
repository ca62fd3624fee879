"""Column expressions: no jobs, no state."""
