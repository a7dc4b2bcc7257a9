"""Operators for preparing training data: counting, filtering, deduplicating, mixing and encoding texts."""
