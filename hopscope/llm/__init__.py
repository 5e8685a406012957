"""Operators for large text corpora, kept apart from the episode library."""
