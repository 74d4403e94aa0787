"""Operators of a training-data pipeline (sharding, counting, filtering,
deduplication, decontamination, packing). Nothing else in the library
imports this subpackage."""
