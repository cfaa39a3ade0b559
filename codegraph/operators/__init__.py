"""Relational operators on nodes, edges and lookups."""
