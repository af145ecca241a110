"""Whole jobs and requests put together from the operators."""
