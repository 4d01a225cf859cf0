"""Relational operators built from DataFrame built-ins."""
