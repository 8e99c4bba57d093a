"""Snapshot files in, published tables out."""
