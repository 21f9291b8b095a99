"""Redaction of streams of blocks."""
