"""Readers and writers around the pure operators."""
