"""Aggregate air-traffic activity on Spark: snapshots in, grouped tables out."""
