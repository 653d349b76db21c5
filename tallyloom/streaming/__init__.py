"""Structured Streaming forms of the two cumulative folds."""
