"""Column-level building blocks: seeded hashing, text and number parsing, type selection."""
