"""roadsift: driving-scenario mining expressed as Spark DataFrame jobs."""
