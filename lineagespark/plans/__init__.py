"""Registered queries: one per operator, over tables derived from the driver data."""
