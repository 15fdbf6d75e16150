"""Functions of the survey engine."""
