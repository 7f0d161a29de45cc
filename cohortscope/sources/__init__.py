"""Readers for raw files and for the stored tables."""
