"""Operators of the scenario mining library."""
