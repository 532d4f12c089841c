"""Scalar column helpers: text, numbers, dates and display formats."""
