"""Derived tables as lazy plans, by name."""
