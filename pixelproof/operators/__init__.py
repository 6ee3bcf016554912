"""Relational operators over predictions, features and metrics."""
