"""Composed jobs."""
