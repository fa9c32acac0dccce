"""Structured Streaming queries; the work inside a batch is that of the operators."""
