"""Operators of a training-data pipeline. Nothing outside this folder imports it
except ``__spark_entry__.py`` (guarded) and ``corpus_pipeline.py``."""
