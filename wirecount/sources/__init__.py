"""Readers, sinks and tables."""
