"""quillfold: document-knowledge analytics expressed as Spark plans (events in, folds out)."""
