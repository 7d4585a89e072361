"""Column expressions and the numpy signal helpers used inside tasks."""
