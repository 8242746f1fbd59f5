"""Exome reads, intervals and variants as Spark tables."""
