"""tables."""
