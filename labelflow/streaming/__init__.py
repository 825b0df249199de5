"""Incremental and streaming forms of the labelling jobs."""
