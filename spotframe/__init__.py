"""Spatial measurement analytics on Spark tables of pixels, labels and spots."""
