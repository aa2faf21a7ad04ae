"""Operators of a training-data pipeline over documents, embeddings and token ids.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
