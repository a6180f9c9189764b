"""Compositions of several operators."""
