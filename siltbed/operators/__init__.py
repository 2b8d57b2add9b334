"""Operators: ``DataFrame -> DataFrame``, without I/O, lazy."""
