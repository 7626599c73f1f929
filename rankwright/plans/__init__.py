"""Operators composed into the data products users run."""
