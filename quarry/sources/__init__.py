"""Scans, sinks and derived views of the driver tables."""
