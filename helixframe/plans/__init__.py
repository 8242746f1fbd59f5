"""Derived views and queries over files."""
