"""Scans, sinks and the fixed schemas of the end-to-end jobs."""
