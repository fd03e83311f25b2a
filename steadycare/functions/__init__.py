"""Column expressions: every function here takes and returns Columns (or renames columns of a frame)."""
