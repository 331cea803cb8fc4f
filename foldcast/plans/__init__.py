"""Whole pipelines: the feature table and the training runs."""
