"""Scalar helpers: scales and names on the driver, column expressions for angles and text."""
