"""Operators for preparing training text. Nothing outside this package and ``corpus_pipeline`` imports it."""
