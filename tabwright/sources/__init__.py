"""Readers and writers for raw and curated tables."""
