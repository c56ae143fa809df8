"""Composition of operators into the star schema and its published tables."""
