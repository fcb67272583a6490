"""Operators that prepare text for training: filtering, deduplication, indexing, packing, archives and mixing."""
