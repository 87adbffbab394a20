"""Structured Streaming twins of the intraday operators."""
