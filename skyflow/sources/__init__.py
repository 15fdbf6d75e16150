"""Sources of the survey engine."""
