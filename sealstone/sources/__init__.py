"""Scans, sinks and the hooks for recognition and download."""
