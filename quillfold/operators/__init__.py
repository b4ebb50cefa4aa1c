"""Relational, record, feed, text, pipeline and evaluation operators over the registered tables."""
