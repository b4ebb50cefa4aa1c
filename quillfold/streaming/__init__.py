"""Structured Streaming forms of the record folds."""
