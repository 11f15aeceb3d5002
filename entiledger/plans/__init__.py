"""Whole jobs: they read tables, apply the operators and write the results."""
