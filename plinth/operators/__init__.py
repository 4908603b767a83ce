"""Plinth operators."""
