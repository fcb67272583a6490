from __future__ import annotations

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pressgrid import dedup_articles, dedup_counts, normalize_articles, sort_articles, union_fetches
from pressgrid.operators.articles import match_terms
from pressgrid.schemas import ARTICLE
from pressgrid.sources import flatten_articles

PAGE = dict(
    status="ok", success=True, title="River ferry back on the Oldport line", language="da", published_at="2031-02-03T04:05:06Z",
    description="Crossings resume after the storm.", final_url="https://shore.test/ferry", excerpt="The Harbour Authority said ...",
    text="The Harbour Authority said on Monday that the river ferry sails again.", text_length=9000,
)
NEWS = dict(
    url="https://shore.test/ferry", url_mobile="", title="Ferry update", seendate="20310203T050607Z",
    socialimage="https://shore.test/boat.png", domain="shore.test", language="Danish", sourcecountry="Denmark",
)


def test_article_with_page(raw):
    rows = normalize_articles(raw({**NEWS, "scraped": PAGE}), ["river ferry"], [], ["Harbour Authority"], [" SEA "])
    assert rows.columns[:24] == ARTICLE.fieldNames()
    assert [f.dataType.simpleString() for f in rows.schema.fields[:24]] == [
        f.dataType.simpleString() for f in ARTICLE.fields]
    got = rows.first()
    assert got.seen_at == datetime(2031, 2, 3, 5, 6, 7) and got.mobile_url is None
    assert (got.matched_keywords, got.matched_entities) == (["river ferry"], ["Harbour Authority"])
    assert (got.scrape_success, got.scraped_published_at, got.scraped_text) == (True, PAGE["published_at"], PAGE["text"])
    assert got.scraped_text_length == 9000  # as declared, not counted
    assert got.requested_themes == [" SEA "]
    assert got.article_id == hashlib.sha256(NEWS["url"].encode()).hexdigest()
    assert json.loads(got.raw)["socialimage"] == "https://shore.test/boat.png"


def test_article_without_anything(raw):
    got = normalize_articles(raw({}), ["x"]).first()
    assert got.article_id is None and got.title is None and got.seen_at is None
    assert (got.scrape_status, got.scrape_success, got.scraped_text_length) == ("not_requested", False, 0)
    assert got.matched_keywords == [] and got.matched_entities == [] and got.requested_themes == []


def test_texts_are_stripped_but_match_space_keeps_domain(raw):
    got = normalize_articles(
        raw(dict(url="  HTTPS://a/B ", title="  T　", domain=" d.com ", sourcecountry=" DE ")),
        ["t  d.com", "d.com   de", "missing"], ["T", "T"],
    ).first()
    assert (got.url, got.title, got.domain, got.source_country) == ("HTTPS://a/B", "T", "d.com", "DE")
    assert got.article_id == hashlib.sha256(b"HTTPS://a/B").hexdigest()
    assert got.matched_keywords == ["t  d.com", "d.com   de", "T", "T"]  # order and repeats kept


def test_bad_seen_date_fails_unless_lenient(raw):
    with pytest.raises(Exception):
        normalize_articles(raw(dict(seendate="2026-04-16"))).collect()
    assert normalize_articles(raw(dict(seendate="2026-04-16")), strict_dates=False).first().seen_at is None


def test_match_terms_is_caseless(values):
    texts = ["Der STRASSENBAU am Ort", "party", None]
    assert values(lambda c: match_terms(c, ["Straße", " art ", ""]), *texts) == [["Straße"], ["art"], []]


def test_dedup_first_fetch_wins(raw):
    rows = raw(
        dict(url="https://a/1", title="late", window_index=1, position=0),
        dict(url=" HTTPS://A/1 ", title="first", window_index=0, position=5),
        dict(url="https://a/2"),
        dict(title="T", seendate="20260101T000000Z", domain="D"),
        dict(title=" t ", seendate="20260101T000000Z", domain="d"),
        dict(title="t", seendate="20260101T000001Z", domain="d"),
        dict(url="", title=""), dict(), dict(domain=" "),
    )
    kept = dedup_articles(rows).collect()
    assert sorted(r.title or "" for r in kept) == ["", "", "T", "first", "t"]
    assert tuple(dedup_counts(rows).first()) == (9, 5, 4)
    assert dedup_counts(rows.limit(0)).first().asDict() == {
        "raw_article_count": 0, "deduplicated_article_count": 0, "duplicates_removed": 0}


def test_two_overlapping_windows(raw):
    """Four rows in two fetches, one of them twice; newest first."""
    one = raw(dict(url="https://e/1", seendate="20260415T010000Z"), dict(url="https://e/2", seendate="20260415T020000Z"))
    two = raw(
        dict(url="https://e/2", seendate="20260415T020000Z", window_index=1),
        dict(url="https://e/3", seendate="20260416T010000Z", window_index=1),
    )
    both = union_fetches([one, two])
    assert tuple(dedup_counts(both).first()) == (4, 3, 1)
    assert [r.url[-1] for r in sort_articles(dedup_articles(both), "DateDesc").collect()] == ["3", "2", "1"]


def test_sorts_are_stable(raw):
    rows = raw(
        dict(title="a", seendate="20260102T000000Z", tone=1.0, window_index=0, position=0),
        dict(title="b", seendate="20260101T000000Z", tone=3.0, window_index=0, position=1),
        dict(title="c", seendate="20260102T000000Z", tone=9.0, window_index=1, position=0),
        dict(title="d", seendate=None, tone=None, window_index=0, position=2),
    )

    def order(sort):
        return "".join(r.title for r in sort_articles(rows, sort).collect())

    assert order("DateDesc") == "acbd" and order("DateAsc") == "dbac"
    assert order("HybridRel") == "abdc"
    assert order("ToneDesc") == "badc" and order("ToneAsc") == "abdc"
    with pytest.raises(ValueError):
        order("Random")


def test_flat_articles(raw):
    rows = normalize_articles(raw({**NEWS, "scraped": PAGE}), ["river ferry", "update"], [], [], ["A", "B"])
    flat = flatten_articles(rows)
    assert len(flat.columns) == 19
    got = flat.first()
    assert got.matched_keywords == "river ferry | update" and got.requested_themes == "A | B"
    assert got.mobile_url == "" and got.seen_at == "2031-02-03T05:06:07Z" and got.scraped_text_length == "9000"
    assert {"raw", "scraped_text", "scrape_error", "scrape_success", "scraped_final_url"}.isdisjoint(flat.columns)


def test_hot_address_leaves_one_row(spark, raw):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("https://hot/")).otherwise(F.concat(F.lit("https://x/"), "id")).alias("url"),
        F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("seendate"),
        F.lit(None).cast("string").alias("domain"), F.lit(0).alias("window_index"),
        F.col("id").cast("int").alias("position"),
    ).repartition(16)
    kept = dedup_articles(rows)
    assert kept.count() == 20000 - 6667 + 1
    assert kept.filter("url = 'https://hot/'").first().position == 0
