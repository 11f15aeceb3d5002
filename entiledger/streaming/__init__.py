"""Loads that arrive over time."""
