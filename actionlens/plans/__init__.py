"""Composed analyses (feature sets, submissions, model stage) and the query catalog."""
