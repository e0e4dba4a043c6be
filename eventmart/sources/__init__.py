"""Readers of tables, lines and streams."""
