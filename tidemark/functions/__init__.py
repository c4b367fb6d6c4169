"""Column expressions and Python-function helpers."""
