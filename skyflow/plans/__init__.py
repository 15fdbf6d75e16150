"""Plans of the survey engine."""
