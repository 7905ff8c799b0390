"""Keeping results current as facts arrive."""
