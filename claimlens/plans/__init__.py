"""Derived views and the registered query catalogue."""
