"""Operators for large-scale training-data pipelines over the ``documents`` and ``embeddings`` tables."""
