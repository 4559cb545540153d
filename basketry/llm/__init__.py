"""Operators for training-data pipelines over the ``documents`` and ``embeddings`` tables."""
