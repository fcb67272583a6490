"""Readers, writers and staging."""

from pressgrid.sources.readers import read_articles, read_corpus, read_pages, read_timeline, with_seen_at
from pressgrid.sources.staging import STAGES, Stages, shared_folder, stage
from pressgrid.sources.writers import flatten_articles, land_articles, write_articles_csv, write_sections

__all__ = [
    "STAGES", "Stages", "flatten_articles", "land_articles", "read_articles", "read_corpus", "read_pages", "read_timeline",
    "shared_folder", "stage", "with_seen_at", "write_articles_csv", "write_sections",
]
