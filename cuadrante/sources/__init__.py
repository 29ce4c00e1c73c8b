"""Sources, sinks and catalog jobs."""
