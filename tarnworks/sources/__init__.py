"""Scans of the model tables and sinks."""
