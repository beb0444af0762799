"""Leak and dependency-trend analytics over code-push events, as Spark plans."""
