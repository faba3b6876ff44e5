"""Frame-level operators."""
