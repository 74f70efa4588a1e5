"""Operators for training-data pipelines: filters, scores, de-duplication,
decontamination, mixing and sharding of document tables.

Nothing outside this package imports it, except ``__spark_entry__.py`` (which
works without it) and ``corpus_pipeline.py``.
"""
