"""Operators of a training-data pipeline: joins, deduplication, quality, sharding, packing and formatting of documents."""
