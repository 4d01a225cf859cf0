"""Staging views, reference views and marts as DataFrame functions (2.O)."""
