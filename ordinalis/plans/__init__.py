"""Composite jobs made of the operators."""
