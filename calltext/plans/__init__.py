"""Pipelines over the call tables."""
