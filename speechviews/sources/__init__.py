"""Readers: files, catalog tables, models and message streams."""
