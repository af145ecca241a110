"""Landed files, tables and sinks."""
