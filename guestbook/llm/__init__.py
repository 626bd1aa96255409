"""Operators for training data: filtering, deduplication, extraction, formatting and mixing."""
