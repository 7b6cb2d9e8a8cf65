"""Whole jobs, from reading to writing."""
