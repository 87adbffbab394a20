"""Marts and model pipelines built from the operators; tables in, tables out."""
