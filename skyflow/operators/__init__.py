"""Operators of the survey engine."""
