"""Operators for preparing training data at scale, and the pipeline's building blocks."""
