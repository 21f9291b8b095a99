"""Pseudonymisation of personal names over Spark tables of text blocks."""
