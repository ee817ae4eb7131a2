"""End-to-end jobs and the query catalogue over the driver's tables."""
