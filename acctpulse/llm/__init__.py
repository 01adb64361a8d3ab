"""Operators for cleaning and shaping text corpora, one module each."""
