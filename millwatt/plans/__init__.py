"""Queries and jobs composed from operators."""
