"""Scalar column helpers and the distributed ranking primitive."""
