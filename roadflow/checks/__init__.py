"""Queries over the generated tables and their SQL twins."""
