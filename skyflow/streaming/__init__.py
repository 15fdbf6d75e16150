"""Streaming of the survey engine."""
