"""Functions of the scenario mining library."""
