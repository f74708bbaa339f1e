"""Relational operators of the workload as DataFrame -> DataFrame functions."""
