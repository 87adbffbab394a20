"""Scans, landed-payload parsers, keyed sinks and the adapters onto the sample tables."""
