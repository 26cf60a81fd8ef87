"""Output tables."""
