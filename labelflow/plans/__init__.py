"""Composed jobs: normalization and end-to-end labelling."""
