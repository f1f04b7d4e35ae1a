"""Layers of the model and the analysis queries over it."""
