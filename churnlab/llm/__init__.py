"""Operators of a training-data pipeline: decontamination, toxicity, substring
and line de-duplication, similarity join, sharding, WARC archives, mixing,
quality rules and personal data. Nothing outside this subpackage imports it."""
