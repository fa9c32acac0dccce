"""Whole jobs. Each takes its clock and its paths as arguments; any scheduler can run it."""
