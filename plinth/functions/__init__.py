"""Plinth functions."""
