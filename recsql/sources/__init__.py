"""Scans, sinks and the driver-table views."""
