"""Operators for preparing large text and vector collections for training.

One module per operator; ``queries`` registers one query for each.  Nothing
outside this subpackage (and ``corpus_pipeline``) imports it.
"""
