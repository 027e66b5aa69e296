"""Readers for files, tables and feeds."""
