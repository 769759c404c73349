"""Typed inputs: batch tables, product events, topics and marts."""
