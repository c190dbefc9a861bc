"""Continuous form of the batch plans."""
