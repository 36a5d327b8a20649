"""Layered batch and streaming analytics over item attributes and click events, on Spark."""
