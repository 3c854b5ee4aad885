"""Independent checks: the same results as plain SQL over the sample tables."""
