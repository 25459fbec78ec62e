"""Composed plans: the layer-by-layer run and the registered queries
with their independent SQL oracles."""
