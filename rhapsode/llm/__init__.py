"""Operators for preparing training data; one module for each operator.

Nothing outside this folder (but the entry module and ``corpus_pipeline``) imports it.
"""
