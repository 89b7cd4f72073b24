"""Vocabularies, thresholds and rule tables."""
