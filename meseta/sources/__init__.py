"""Bronze scans, landing sinks and catalog tables."""
