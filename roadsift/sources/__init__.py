"""Sources of the scenario mining library."""
