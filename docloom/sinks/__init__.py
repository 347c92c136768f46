"""Sinks: staging tables, versions and their public names."""
