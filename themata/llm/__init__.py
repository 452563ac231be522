"""Operators for training corpora: packing, joins, deduplication, filters, counts and decontamination."""
