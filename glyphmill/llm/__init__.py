"""Operators for preparing training corpora: dedup, decontamination, joins, mixing, extraction, scoring and output."""
