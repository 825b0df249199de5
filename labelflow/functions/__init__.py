"""Column expressions: everything here stays inside Catalyst, no Python per row."""
