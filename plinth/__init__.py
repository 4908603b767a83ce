"""Plinth: a PySpark-native engine for building, street-view and LiDAR analytics."""
