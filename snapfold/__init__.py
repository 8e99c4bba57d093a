"""Snapshot-to-KPI engine on Spark DataFrames.

Full snapshots of keyed business records go in; cleaned, change-tracked state
and two aggregate tables come out.  Everything is a lazily built DataFrame plan;
nothing but row counts and key reports ever reaches the driver.
"""
