"""Cycles driven by arriving snapshots."""
