"""Bulk table profile, chunk planning, export, load, reconcile and monitoring on Spark."""
