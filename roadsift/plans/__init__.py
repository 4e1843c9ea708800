"""Plans of the scenario mining library."""
