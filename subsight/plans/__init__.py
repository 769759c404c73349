"""Compositions of operators: the mart layer and the daily run."""
