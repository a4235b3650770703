"""Operators for training text: mixing, privacy, duplicates, languages, quality, scoring, output."""
