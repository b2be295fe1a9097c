"""Data operators, each a composition of built-in DataFrame operations."""
