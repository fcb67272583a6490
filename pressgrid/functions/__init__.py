"""Scalar column expressions."""

from pressgrid.functions.numbers import first_number, to_number
from pressgrid.functions.text import (
    blank_to_null,
    clean,
    compact_key,
    compact_whitespace,
    count_words,
    fold,
    strip,
    words_within,
)
from pressgrid.functions.times import (
    bucket,
    compact_second,
    iso_utc,
    seen_timestamp,
    timeline_timestamp,
    use_utc,
)

__all__ = [
    "blank_to_null", "bucket", "clean", "compact_key", "compact_second", "compact_whitespace",
    "count_words", "first_number", "fold", "iso_utc", "seen_timestamp", "strip", "timeline_timestamp",
    "to_number", "use_utc", "words_within",
]
