"""Operators for training data: search, scoring, scanning, deduplication, mixing and encoding."""
