"""Operators over whole tables: joins, distances, selection, graphs, trees, statistics."""
