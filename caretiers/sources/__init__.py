"""Readers and writers: bundles, delimited files, the landing zone and tables."""
