"""Operators for large text corpora: deduplication, classifiers, token counts, packing and mixing."""
