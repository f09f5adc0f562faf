"""Whole jobs: building the batch view, training the sentiment model."""
