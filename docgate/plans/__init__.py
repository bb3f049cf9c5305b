"""Composed batch jobs."""
