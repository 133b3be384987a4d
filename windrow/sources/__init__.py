"""Sources, sinks and catalog."""
