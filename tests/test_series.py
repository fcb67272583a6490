from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pressgrid import (
    entity_tracking, normalize_articles, normalize_timeline, ranked_counts, rankings, rebucket, sentiment_series,
    tone_timeline, trend_series, volume_series, volume_timeline,
)
from pressgrid.operators.series import series_source
from pressgrid.operators.summary import dataset_summary
from pressgrid.schemas import LISTED_POINT, SERIES


@pytest.fixture
def points(spark):
    def build(*rows):
        names = LISTED_POINT.fieldNames()
        return spark.createDataFrame(
            [tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows], LISTED_POINT)

    return build


def plain(series):
    return [tuple(r)[:5] for r in series.orderBy("bucket_start", "metric").collect()]


def test_timeline_golden(points):
    rows = normalize_timeline(points(
        dict(date="20260416000000", value=12, norm=1000), dict(date="20260416010000", value=18, norm=1100)), "article_count")
    assert rows.schema.simpleString() == SERIES.simpleString()
    assert [(r.value, r.norm) for r in rows.collect()] == [(12, 1000), (18, 1100)]


def test_timeline_alternatives(points):
    rows = normalize_timeline(points(
        dict(date="", datetime="20260416", value="n/a", count="3", total=9),
        dict(time="2026-04-16T01:00:00Z", tone="-1.5", allarts="x", label="L"),
        dict(date="20260416", value=""), dict(value=4), dict(date="someday", ratio=0.5),
    ), "m")
    got = sorted((r.bucket_start or datetime.min, r.value, r.norm, r.label) for r in rows.collect())
    assert got == [
        (datetime.min, 0.5, None, None), (datetime(2026, 4, 16), 3.0, 9.0, None), (datetime(2026, 4, 16, 1), -1.5, None, "L")]


def test_rebucket_golden(points):
    volume = normalize_timeline(points(
        dict(date="20260416001000", value=2, norm=20, label="a"), dict(date="20260416004000", value=3, norm=30)), "article_count")
    assert plain(rebucket(volume, "hour", "sum")) == [(datetime(2026, 4, 16), 5.0, "article_count", 50.0, None)]
    tone = normalize_timeline(points(
        dict(date="20260416000500", value=1.0, norm=2), dict(date="20260416005500", value=4.0, norm=1)), "average_tone")
    assert plain(rebucket(tone, "hour", "weighted_average")) == [(datetime(2026, 4, 16), 2.0, "average_tone", 3.0, None)]
    with pytest.raises(ValueError, match="aggregation"):
        rebucket(tone, "hour", "median")


def test_weights_fall_back_to_one(points):
    rows = normalize_timeline(points(
        dict(date="20260416", value=1, norm=None), dict(date="20260416", value=2, norm=0), dict(date="20260416", value=3, norm=-2),
        dict(date="20260416", value=10, norm=2)), "t")
    assert plain(rebucket(rows, "day", "weighted_average")) == [(datetime(2026, 4, 16), 26 / 5, "t", None, None)]
    negative = normalize_timeline(points(dict(date="20260416", value=1, norm=-3)), "t")
    assert plain(rebucket(negative, "day", "sum"))[0][3] == -3.0


def test_rebucket_coerces_text_norms(spark):
    rows = spark.createDataFrame([(datetime(2026, 1, 1), 1.0, "m", "4", None), (datetime(2026, 1, 1), 2.0, "m", "many", None),
                                  (None, 5.0, "m", "1", None), (datetime(2026, 1, 1), None, "m", "1", None)],
                                 "bucket_start timestamp, value double, metric string, norm string, label string")
    assert plain(rebucket(rows, "day", "sum")) == [(datetime(2026, 1, 1), 3.0, "m", 4.0, None)]


def test_rebucket_against_a_loop(spark, points):
    pick = random.Random(3)
    data = [(f"202604{pick.randint(10, 12)}{pick.randint(0, 3):02}{pick.randint(0, 59):02}00", pick.uniform(-5, 5),
             pick.choice([None, 0, -1, pick.randint(1, 50)])) for _ in range(400)]
    rows = normalize_timeline(points(*(dict(date=d, value=v, norm=n) for d, v, n in data)), "m")
    groups = defaultdict(list)
    for d, v, n in data:
        groups[datetime.strptime(d[:10], "%Y%m%d%H")].append((v, n))
    got = {r.bucket_start: (r.value, r.norm) for r in rebucket(rows, "hour", "weighted_average").collect()}
    assert got.keys() == groups.keys()
    for start, pairs in groups.items():
        weights = [n if n is not None and n > 0 else 1.0 for _, n in pairs]
        mean = sum(v * w for (v, _), w in zip(pairs, weights)) / sum(weights)
        total = sum(n for _, n in pairs if n is not None) or None
        assert got[start][0] == pytest.approx(mean) and got[start][1] == total


def _news(raw, *times, **more):
    return normalize_articles(raw(*(dict(title=f"European Union {i}", seendate=t, **more) for i, t in enumerate(times))),
                              entities=["European Union", "Union 1", "European Union"])


def test_volume_and_entities(raw):
    rows = _news(raw, "20260416T144500Z", "20260416T145500Z", "20260418T000000Z", None)
    assert plain(volume_series(rows, "hour")) == [
        (datetime(2026, 4, 16, 14), 2.0, "article_count", None, None), (datetime(2026, 4, 18), 1.0, "article_count", None, None)]
    tracked = {(r.bucket_start.day, r.entity): r.article_count for r in entity_tracking(rows, "day").collect()}
    assert tracked == {(16, "European Union"): 4, (16, "Union 1"): 1, (18, "European Union"): 2}
    assert entity_tracking(normalize_articles(raw(dict(title="x", seendate="20260416T144500Z"))), "day").count() == 0


def test_trend_falls_back_only_without_any_row(raw, points):
    rows = _news(raw, "20260416T144500Z", "20260416T145500Z")
    empty = normalize_timeline(points(dict(value=1)), "article_count")
    unreadable = normalize_timeline(points(dict(date="someday", value=1)), "article_count")
    given = normalize_timeline(points(dict(date="20260101", value=7)), "article_count")
    assert [(r.value, r.source) for r in trend_series(rows, None, "hour").collect()] == [(2.0, "article-bucket-fallback")]
    assert [(r.value, r.source) for r in trend_series(rows, empty, "hour").collect()] == [(2.0, "article-bucket-fallback")]
    assert [(r.value, r.source) for r in trend_series(rows, given, "hour").collect()] == [(7.0, "supplied-timeline")]
    assert trend_series(rows, unreadable, "hour").count() == 0
    assert sentiment_series(None, "day") is None
    for rows_given, name in ((given, "supplied"), (unreadable, "supplied"), (empty, "none")):
        assert series_source(rows_given, "supplied", "none", "s").first().s == name
    assert series_source(sentiment_series(unreadable, "day"), "supplied", "none", "s").first().s == "none"


def test_timelines_from_articles(raw):
    from pressgrid.sources import with_seen_at

    rows = with_seen_at(raw(
        dict(title="a", seendate="20260416T144500Z", tone=2.0), dict(title="b", seendate="20260416T144600Z", tone=4.0),
        dict(title="ab", seendate="20260417T144600Z"), dict(title="a")))
    assert plain(volume_timeline(rows, F.col("title").contains("b"), "day")) == [
        (datetime(2026, 4, 16), 1.0, "article_count", 2.0, None), (datetime(2026, 4, 17), 1.0, "article_count", 1.0, None)]
    assert plain(tone_timeline(rows, "day")) == [(datetime(2026, 4, 16), 3.0, "average_tone", 2.0, None)]


def test_ranked_counts_keep_first_appearance(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), ("a", 4), ("b", 5), ("", 6), (None, 7)], "v string, appearance long")
    assert [(r.value, r["count"]) for r in ranked_counts(rows, "v").collect()] == [("b", 2), ("a", 2), ("c", 1)]


def test_rankings_follow_the_sort(raw):
    rows = normalize_articles(raw(
        dict(language="en", domain="x", title="u v", seendate="20260101T000000Z"),
        dict(language="fr", domain="x", title="v", seendate="20260102T000000Z"), dict(language="de", title="u")), entities=["v", "u"])

    def names(sort, kind="languages"):
        return [r.value for r in rankings(rows, sort)[kind].collect()]

    assert names("HybridRel") == ["en", "fr", "de"]
    assert names("DateDesc") == ["fr", "en", "de"] and names("DateAsc") == ["de", "en", "fr"]
    assert names("HybridRel", "domains") == ["x"]
    assert names("HybridRel", "matched_entities") == ["v", "u"] and names("DateAsc", "matched_entities") == ["u", "v"]


def test_summary_counts_every_other_state_as_failed(raw):
    pages = [dict(status=s, success=s == "ok") for s in ("ok", "error", "skipped")]
    rows = raw(*({"scraped": p} for p in pages), {})
    got = dataset_summary(normalize_articles(rows), rows.union(rows)).first()
    assert tuple(got) == (4, 8, 4, 1, 2)
