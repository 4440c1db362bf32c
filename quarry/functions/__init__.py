"""Column-expression helpers (hashing, text, time, log parsing, JSON, URLs)."""
