"""Compositions of operators offered as one call."""
