"""Operators of a training-data pipeline: filters, deduplication, mixing and packing of documents."""
