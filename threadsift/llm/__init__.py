"""Corpus operators for training data: dedup, filters, classifiers, mixing.

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; ``entry`` registers one query per
operator and the pipeline.
"""
