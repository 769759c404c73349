"""Structured Streaming path of product events."""
