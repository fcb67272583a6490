from __future__ import annotations

import random
import re
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from pressgrid.functions import (
    bucket, clean, compact_key, compact_second, compact_whitespace, count_words, first_number, fold, iso_utc,
    seen_timestamp, strip, timeline_timestamp, to_number, words_within,
)
from pressgrid.functions.text import fold_words


def test_strip_removes_all_unicode_space(values):
    texts = ["  a ", " 　x y \n", "\x1f\x85b\t", "", "​kept​"]
    assert values(strip, *texts) == [t.strip() for t in texts]
    assert values(clean, "  ", None, " z ") == [None, None, "z"]


def test_compaction(values):
    texts = [" a \n\t b  c ", "plain", "   "]
    assert values(compact_whitespace, *texts) == [re.sub(r"\s+", " ", t).strip() for t in texts]
    assert values(compact_key, " United  States ") == ["unitedstates"]


FOLDED = ["Straße", "ΣΊΣΥΦΟΣ", "µm ſet", "İstanbul", "ﬁnd ﬀ ﬃ", "ꭰꭱᏸ", "ŉ ǰ ΐ ẞ և ﬓ", "ᾈ ᾳ ᾼ ῼ", "ΑΣ ΑΣΑ", "plain ASCII",
          "Éçà", "ϐϑϕϖϰϱϵẛ", "ͅι"]


def test_fold_equals_casefold(values):
    assert values(fold, *FOLDED) == [t.casefold() for t in FOLDED]


def test_fold_equals_casefold_on_random_text(values):
    pick = random.Random(7)
    letters = [chr(c) for c in (*range(0x41, 0x250), *range(0x370, 0x590), *range(0x1E00, 0x2000), *range(0xFB00, 0xFB18))
               if chr(c).isalpha()]
    texts = ["".join(pick.choice(letters + [" "] * 40) for _ in range(pick.randint(1, 60))) for _ in range(1500)]
    assert values(fold, *texts) == [t.casefold() for t in texts]


def _words(text: str) -> list[str]:
    return fold_words(text)


def test_count_words(values):
    texts = ["the the, THE other", "", "theme the", "of the of the of the", "a b a b a"]
    assert values(lambda c: count_words(fold(c), ["the"]).cast("int"), *texts)[:4] == [3, 0, 1, 3]
    assert values(lambda c: count_words(fold(c), ["of", "the"]).cast("int"), *texts)[3] == 3
    # Occurrences do not overlap.
    assert values(lambda c: count_words(fold(c), ["a", "b", "a"]).cast("int"), *texts)[4] == 1


@pytest.mark.parametrize("terms,distance", [(["a", "b"], 1), (["a", "b"], 3), (["a", "b", "c"], 4), (["a", "a"], 1)])
def test_words_within_against_all_pairs(values, terms, distance):
    pick = random.Random(distance)
    texts = [" ".join(pick.choice("abcxyz") for _ in range(pick.randint(0, 25))) for _ in range(300)]

    def expected(text):
        words = text.split()
        return any(
            all(words[at:at + distance + 1].count(term) >= terms.count(term) for term in terms) for at in range(len(words))
        )

    assert values(lambda c: words_within(c, terms, distance), *texts) == list(map(expected, texts))


def test_words_within_long_text_of_hits_only(values):
    assert values(lambda c: words_within(c, ["a", "b"], 1), "a " * 20000 + "b", "a " * 20000) == [True, False]


def test_to_number(values):
    texts = ["12", " 1.5 ", "", None, "1.0d", "abc", "1e3", "-.5", "1_000", "nan", "true", "0x10", "+7", "5."]
    got = values(to_number, *texts)
    assert str(got[9]) == "nan"
    got[9] = None
    assert got == [12.0, 1.5, None, None, None, None, 1000.0, -0.5, 1000.0, None, None, None, 7.0, 5.0]


def test_first_number_falls_through(spark):
    rows = spark.createDataFrame([("x", "", "3"), ("0", "5", "6"), (None, None, "n/a")], "a string, b string, c string")
    assert [r[0] for r in rows.select(first_number(*map(F.col, "abc"))).collect()] == [3.0, 0.0, None]


def test_seen_timestamp(values, spark):
    assert values(seen_timestamp, "20260416T144500Z", "", None) == [datetime(2026, 4, 16, 14, 45), None, None]
    assert values(lambda c: seen_timestamp(c, strict=False), "bad", "20260416T144500Z")[0] is None
    with pytest.raises(Exception, match="(?i)timestamp|pars"):
        values(seen_timestamp, "not a date")


def test_timeline_timestamp(values):
    texts = ["20260416T001000Z", "20260416001000", "20260416", "2026-04-16T00:10:00Z", "2026-04-16",
             "2026-04-16T02:10:00+02:00", "soon", "2026", "T10:00", "2026-99-99", "99999999", None]
    ten_past, midnight = datetime(2026, 4, 16, 0, 10), datetime(2026, 4, 16)
    assert values(timeline_timestamp, *texts) == [
        ten_past, ten_past, midnight, ten_past, midnight, ten_past, None, None, None, None, None, None,
    ]


def test_bucket_and_formats(values):
    def at(size):
        return lambda c: iso_utc(bucket(c.cast("timestamp"), size))

    text = "2024-03-05 06:07:08.9"
    assert values(at("minute"), text) == ["2024-03-05T06:07:00Z"]
    assert values(at("hour"), text) == ["2024-03-05T06:00:00Z"]
    assert values(at("day"), text) == ["2024-03-05T00:00:00Z"]
    assert values(lambda c: iso_utc(c.cast("timestamp")), text) == ["2024-03-05T06:07:08.900000Z"]
    assert values(lambda c: compact_second(c.cast("timestamp")), text) == ["20240305060708"]
    with pytest.raises(ValueError, match="bucket size"):
        bucket(F.lit(None), "week")


def test_request_dates_without_zone_are_utc():
    from pressgrid.plans.request import utc

    assert utc("2024-01-01T01:00:00") == datetime(2024, 1, 1, 1, tzinfo=UTC)
    assert utc("2024-01-01T01:00:00+01:00") == datetime(2024, 1, 1, tzinfo=UTC)
    assert utc(" ") is None
