"""Plans: end-to-end jobs, sinks and the driver's query catalogue."""
