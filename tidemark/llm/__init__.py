"""Operators for preparing language-model training data, all on Spark DataFrames.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
