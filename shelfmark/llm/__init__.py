"""Operators that prepare text for training: scoring, near-duplicates, language, packing, decontamination, personal data, extraction."""
