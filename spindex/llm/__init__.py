"""Operators of a training-data pipeline: scoring, packing, deduplication,
archives, binary output, quality rules, sharding and mixing. Nothing outside
this subpackage imports it (``__spark_entry__`` only if it is there)."""
