"""Readers, tables and sinks."""
