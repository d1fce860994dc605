"""Composed jobs: the two extractions and the participant report."""
