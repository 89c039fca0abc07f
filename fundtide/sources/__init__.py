"""Scans, sinks and adapters."""
