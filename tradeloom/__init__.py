"""Incremental commerce data on Spark: landing, keyed tables, marts, publishing."""
