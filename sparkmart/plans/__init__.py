"""Composite jobs (PIP-1..16): the mart layers and model jobs, each over a window of snapshots.

The reference runs each layer once per snapshot date (a driver loop, rescanning sources per
date).  Here each layer is one Spark job over the whole window, written with dynamic
partition overwrite, so a backfill of N months is one scan per layer instead of N.
"""
