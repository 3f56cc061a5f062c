"""Incremental loading and the bronze, silver and gold steps."""
