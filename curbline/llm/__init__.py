"""Operators that prepare a text corpus: filter, deduplicate, decontaminate, pack."""
