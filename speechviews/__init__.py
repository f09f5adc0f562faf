"""Batch and live analysis of transcribed speech recordings on Spark DataFrames."""
