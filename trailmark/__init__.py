"""Marketplace event analytics on Spark."""
