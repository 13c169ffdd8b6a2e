"""Spatial-trajectory and point-cloud analytics as DataFrame jobs."""
