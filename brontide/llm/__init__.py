"""Operators of a training-data pipeline: language, quality, near duplicates, mixing, packing and more."""
