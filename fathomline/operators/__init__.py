"""Relational and stateful operators over survey tables."""
