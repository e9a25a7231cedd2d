"""Column helpers: plain expressions, no Python per row."""
