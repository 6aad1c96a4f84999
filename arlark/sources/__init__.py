"""Readers for source files and the driver test tables."""
