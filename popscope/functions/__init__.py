"""Column expressions and small in-task helpers."""
