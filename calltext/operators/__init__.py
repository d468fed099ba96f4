"""Relational building blocks shared by the pipelines."""
