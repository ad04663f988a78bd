"""Files as they arrive."""
