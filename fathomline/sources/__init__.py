"""Readers: each format becomes a DataFrame with explicit columns."""
