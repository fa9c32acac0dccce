"""Column expressions: text, time and labels, ids."""
