"""Column expressions: tolerant cell parsing and time arithmetic."""
