"""Column-level helpers (text, answer parsing, decision rules)."""
