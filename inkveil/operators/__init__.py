"""Operators on tables of nodes, blocks, segments, people and spans."""
