"""Queries and pipelines put together from the operators."""
