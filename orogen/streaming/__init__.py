"""Streams of point tables."""
