"""Scalar expressions over columns."""
