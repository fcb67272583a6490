"""Text expressions: trimming, case folding, containment and word counting.

Everything here returns a ``Column`` built from Spark's own functions, so it runs inside the JVM.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that Unicode calls white space; all of them lie below U+3001.
WHITESPACE = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())

# A run of anything that is neither a letter nor a digit separates two words.
WORD_SEPARATOR = r"[^\p{L}\p{N}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Catalyst inlines a projected column into a filter above it, once per use. Binding the value to a
    lambda variable keeps an expensive one (folding a whole text) from being repeated per term.
    """
    return F.transform(F.array(value), body)[0]


def holds(value: Column, test: Callable[[Column], Column]) -> Column:
    """Boolean form of :func:`let`, usable in ``filter``; null counts as false."""
    return F.coalesce(F.exists(F.array(value), test), F.lit(False))


def strip(col: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone removes spaces only)."""
    return F.btrim(col.cast("string"), F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def clean(col: Column) -> Column:
    """Stripped text, or null when nothing is left."""
    return blank_to_null(strip(col))


def compact_whitespace(col: Column) -> Column:
    return strip(F.regexp_replace(col, f"[{WHITESPACE}]+", " "))


def compact_key(col: Column) -> Column:
    """Lower case without spaces: the form in which countries and languages are compared."""
    return F.replace(F.lower(strip(col)), F.lit(" "), F.lit(""))


@cache
def fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Where full case folding differs from lower-casing, as (one-to-one, one-to-many) maps.

    Keys are lower-cased characters, since :func:`fold` applies ``lower`` first.
    """
    single: dict[str, str] = {}
    multiple: dict[str, str] = {}
    for cp in range(0x80, 0x20000):
        if 0xD800 <= cp < 0xE000:
            continue
        lowered, folded = chr(cp).lower(), chr(cp).casefold()
        if folded != lowered and len(lowered) == 1:
            (single if len(folded) == 1 else multiple)[lowered] = folded
    return single, multiple


def fold(col: Column) -> Column:
    """Unicode case folding, equal to Python's ``str.casefold``.

    Tiers by cost: pure ASCII needs ``lower`` alone and Latin-1 text two replacements; text beyond that is
    mapped character by character, and the long expansions are tried only where one would apply.
    """
    single, multiple = fold_tables()
    # Both of these lie within Latin-1; every other affected character lies beyond it.
    rare = {k: v for k, v in multiple.items() if k != "ß"}
    # One literal, "<character><expansion>|...", which Catalyst splits once while planning.
    pairs = F.split(F.lit("|".join(k + v for k, v in rare.items())), "[|]")

    def beyond_latin(text: Column) -> Column:
        expanded = F.aggregate(
            pairs, text, lambda done, pair: F.replace(done, F.left(pair, F.lit(1)), F.substring(pair, 2, 3))
        )
        return F.when(F.translate(text, "".join(rare), "") == text, text).otherwise(expanded)

    def by_tier(text: Column) -> Column:
        latin = F.replace(F.replace(text, F.lit("ß"), F.lit("ss")), F.lit("µ"), F.lit("μ"))
        mapped = F.translate(latin, "".join(single), "".join(single.values()))
        return (
            F.when(F.octet_length(text) == F.length(text), text)
            .when(~text.rlike("[Ā-\U0010ffff]"), latin)
            .otherwise(let(mapped, beyond_latin))
        )

    return let(F.lower(col), by_tier)


def fold_words(term: str) -> list[str]:
    """The folded words of a driver-side search term, split as :data:`WORD_SEPARATOR` splits text."""
    folded = term.casefold()
    return "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in folded).split()


def count_words(folded: Column, words: list[str]) -> Column:
    """Non-overlapping occurrences of a word, or of a run of words, in folded text.

    Words are padded with two spaces each, so counting is one ``replace`` and two lengths.
    """
    padded = F.concat(F.lit(" "), F.regexp_replace(folded, WORD_SEPARATOR, "  "), F.lit(" "))
    needle = "  ".join(words).join("  ")
    return let(
        padded,
        lambda text: (
            F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))
        ) / F.lit(len(needle)),
    )


def words_within(folded: Column, words: list[str], distance: int) -> Column:
    """True when all ``words`` occur inside one stretch of ``distance`` words; a word given n times must occur n times.

    One pass over the hits keeps the latest positions of each word, as many as the word is given times; the stretch
    ends at the current hit and starts at the oldest of these positions, so no pair of positions is ever formed. Words
    absent from the text as plain substrings rule it out before it is split.
    """
    wanted = list(dict.fromkeys(words))
    terms = F.array(*map(F.lit, wanted))
    # One slot for each kept position, those of a word side by side with the latest last.
    slots = [term for term, word in enumerate(wanted, 1) for _ in range(words.count(word))]
    owners = F.array(*map(F.lit, slots))
    hits = F.filter(
        F.transform(
            F.split(folded, WORD_SEPARATOR),
            lambda word, at: F.struct(F.array_position(terms, word).alias("slot"), at.alias("at")),
        ),
        lambda hit: hit["slot"] > 0,
    )
    never = F.lit(-(1 << 30))
    start = F.struct(F.array(*[never] * len(slots)).alias("last"), F.lit(False).alias("found"))

    def step(state: Column, hit: Column) -> Column:
        def moved(at: Column, slot: Column) -> Column:
            own, following = F.get(owners, slot) == hit["slot"], F.get(owners, slot + 1) == hit["slot"]
            if len(slots) == len(wanted):
                return F.when(own, hit["at"]).otherwise(at)
            return F.when(own & following, F.get(state["last"], slot + 1)).when(own, hit["at"]).otherwise(at)

        last = F.transform(state["last"], moved)
        span = hit["at"] - F.array_min(last)
        return F.struct(last.alias("last"), (state["found"] | (span <= distance)).alias("found"))

    near = F.aggregate(hits, start, step, lambda state: state["found"])
    present = F.lit(True)
    for word in wanted:
        present = present & folded.contains(word)
    return present & near
