"""Operators for training-data pipelines: archives, personal data, scoring, cleaning, duplicates, tokens."""
