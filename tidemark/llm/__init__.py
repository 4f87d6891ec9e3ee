"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``embeddings``.

Nothing outside this folder imports it. Each module holds one operator; ``queries``
registers their checks and ``corpus_pipeline.py`` (repository root) chains five of them.
"""
