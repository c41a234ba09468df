"""Whole flows: the operators put together."""
