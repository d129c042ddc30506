"""Operators for building text corpora and vocabularies; nothing outside this package imports it."""
