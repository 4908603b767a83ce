"""Plinth sources."""
