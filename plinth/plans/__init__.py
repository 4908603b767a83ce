"""Plinth plans."""
