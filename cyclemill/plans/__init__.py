"""Pipelines put together from the operators."""
