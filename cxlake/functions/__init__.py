"""Column expressions: date resolution, strict casts, fixed text patterns, name cleaning."""
