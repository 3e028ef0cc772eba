"""Structured Streaming queries for ad clicks."""
