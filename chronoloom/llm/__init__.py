"""Operators for preparing training data: text, pages and embeddings as Spark tables."""
