"""Queries over the shared tables, each beside the SQL that states the same result."""
