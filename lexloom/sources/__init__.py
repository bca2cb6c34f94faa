"""Readers of the dictionaries' formats, the source registry, and sinks."""
