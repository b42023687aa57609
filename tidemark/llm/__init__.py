"""Operators of a training-data pipeline: packing, near copies, archives, extraction, filters, search, token files."""
