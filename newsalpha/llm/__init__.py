"""Operators of a training-data pipeline: sharding, deduplication, scans, tokens, languages, extraction."""
