"""Operators and pipeline stages for large text-training corpora."""
