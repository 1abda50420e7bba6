"""Operators of a training-data pipeline: scans, classifiers, joins, search, tokens and shards over a corpus."""
