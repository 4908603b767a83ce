"""Plinth streaming."""
