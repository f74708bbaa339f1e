"""Scalar column helpers and set-based replacements for the stored functions."""
