"""Column expressions: seeded randomness and array arithmetic."""
