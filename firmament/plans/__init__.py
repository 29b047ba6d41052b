"""Composed jobs and the views that derive domain tables from the given test tables."""
