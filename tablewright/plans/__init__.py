"""Composed plans built from the operators."""
