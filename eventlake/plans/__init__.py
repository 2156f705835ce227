"""Whole jobs: training, the model registry and the catalog."""
