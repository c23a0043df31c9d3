"""Shared pieces: table reading, materialising, fixed-point loops, checks."""
