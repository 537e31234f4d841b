"""Composed work: the fitted pipeline, training and scoring jobs, and the query catalog."""
