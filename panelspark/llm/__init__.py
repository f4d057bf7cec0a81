"""Operators for preparing text corpora and embeddings as training data."""
