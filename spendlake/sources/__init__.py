"""Readers of landed pages and batch responses."""
