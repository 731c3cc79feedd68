"""Operators for preparing training text: packing, deduplication, sharding, scans, classifiers."""
