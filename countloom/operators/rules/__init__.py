"""Data-quality rule sets.  Each takes tables and returns issue rows, never repairs."""
