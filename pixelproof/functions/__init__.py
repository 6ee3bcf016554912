"""Column functions and the feature step."""
