"""Readers: lists, dictionaries, document packages, text corpora."""
