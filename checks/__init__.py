"""Queries over the supplied tables and the SQL that states the same results."""
