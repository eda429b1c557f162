"""Readers with row rules, and sinks that can be verified on load."""
