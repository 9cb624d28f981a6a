"""Whole tag jobs composed from sources, operators and sinks."""
