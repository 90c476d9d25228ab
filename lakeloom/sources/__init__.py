"""Sources, sinks and the schemas they enforce."""
