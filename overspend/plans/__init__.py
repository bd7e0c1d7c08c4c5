"""Registered queries, each next to the SQL that states its result."""
