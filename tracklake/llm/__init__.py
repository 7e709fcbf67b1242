"""Operators of a training-data pipeline: packing, decontamination, near-duplicates, filters, extraction, privacy."""
