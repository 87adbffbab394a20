"""Operators over keyed series: windows, as-of joins, aggregates, reshapes, checks."""
