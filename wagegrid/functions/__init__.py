"""Column expressions: salary text, places, markup and words."""
