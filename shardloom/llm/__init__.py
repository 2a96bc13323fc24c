"""Operators of a training-data pipeline: filtering, dedup, extraction, tokens, packing.

Nothing else in the library imports this subpackage."""
