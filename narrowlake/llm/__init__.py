"""Operators for training-data work over documents and embeddings."""
