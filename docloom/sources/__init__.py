"""Sources: named-source scans, key ranges and synonym files."""
