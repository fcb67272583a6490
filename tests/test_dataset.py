from __future__ import annotations

import pytest

from pressgrid import Filters, Request, Sort, TimeRange, build_dataset, write_sections
from pressgrid.plans.contracts import CONTRACTS
from pressgrid.operators.quality import violations
from pressgrid.schemas import LISTED_POINT


def request(**options):
    filters = options.pop("filters", Filters(keywords=["river ferry"], entities=["Harbour Authority"]))
    return Request(filters=filters, date_range=TimeRange("2026-04-15", "2026-04-17"), max_records=50, sort=Sort.NEWEST,
                   bucket_size="hour", **options)


@pytest.fixture
def corpus(raw):
    def article(path, title, seen):
        return dict(url=f"https://shore.test/{path}", title=title, seendate=seen, domain="shore.test", language="English",
                    sourcecountry="Germany", tone=2.0)

    return raw(
        article("a", "Harbour Authority weighs river ferry plan", "20260416T144500Z"),
        article("b", "River ferry timetable published", "20260416T145500Z"),
        article("A", "River ferry timetable published, again", "20260416T150000Z"),
        article("c", "Sports", "20260416T150000Z"),
        article("d", "River ferry before the range", "20260414T150000Z"),
    )


@pytest.mark.parametrize("staged", [True, False])
def test_falls_back_to_local_counts(corpus, staged):
    tables = build_dataset(corpus, request(include_timeline=False, include_tone_timeline=False), staged=staged)
    assert tables["trend_source"].first().trend_source == "article-bucket-fallback"
    assert "sentiment_series" not in tables
    summary = tables["summary"].first()
    # /A repeats /a in another case; newest first inside the window, so the later one is met first.
    assert (summary.article_count, summary.raw_article_count, summary.duplicates_removed) == (2, 3, 1)
    assert summary.scraped_article_count == 0 and summary.scrape_failed_count == 0
    targets = tables["analysis_targets"].first()
    assert targets.trend_metric == "article_count" and targets.tracked_entities == ["Harbour Authority"]
    coverage = tables["coverage"].first()
    assert (coverage.batch_count, coverage.raw_article_count, coverage.deduplicated_article_count) == (2, 3, 2)
    assert coverage.duplicates_removed == 1 and coverage.batching_enabled
    assert tables["windows"].count() == 2 and tables["warnings"].count() == 0
    quality = {r.contract: r for r in tables["quality"].collect()}
    assert quality["articles"].records_checked == 2 and all(r.validated for r in quality.values())
    assert set(quality) == set(CONTRACTS) - {"sentiment_series", "enrichment"}
    assert [r.url[-1] for r in tables["articles"].collect()] == ["A", "b"]  # newest first
    assert [(r.value, r["count"]) for r in tables["domains"].collect()] == [("shore.test", 2)]


def test_golden_local_trend_and_entities(raw):
    rows = raw(
        dict(url="https://shore.test/a", title="Harbour Authority weighs river ferry plan", seendate="20260416T144500Z",
             domain="shore.test", language="English", sourcecountry="Germany"),
        dict(url="https://shore.test/b", title="River ferry timetable published", seendate="20260416T145500Z",
             domain="shore.test", language="English", sourcecountry="Germany"))
    tables = build_dataset(rows, request(include_timeline=False))
    (point,) = tables["trend_series"].collect()
    assert point.value == 2 and point.source == "article-bucket-fallback"
    (tracked,) = tables["entity_tracking"].collect()
    assert tracked.entity == "Harbour Authority" and tracked.article_count == 1
    assert tables["sentiment_source"].first().sentiment_source == "not_available"


def test_supplied_timelines_are_rebucketed(spark, corpus):
    def points(*rows):
        names = LISTED_POINT.fieldNames()
        return spark.createDataFrame([tuple(str(r[n]) if n in r else None for n in names) for r in rows], LISTED_POINT)

    tables = build_dataset(
        corpus, request(),
        timeline=points(dict(date="20260416001000", value=2, norm=20), dict(date="20260416004000", value=3, norm=30)),
        tone=points(dict(date="20260416000500", value=1.0, norm=2), dict(date="20260416005500", value=4.0, norm=1)))
    (trend,) = tables["trend_series"].collect()
    assert (trend.value, trend.norm, trend.label, trend.source) == (5, 50, None, "supplied-timeline")
    (tone,) = tables["sentiment_series"].collect()
    assert (tone.value, tone.norm) == (2.0, 3)
    for name in ("trend_series", "sentiment_series", "entity_tracking", "domains", "summary", "coverage", "windows"):
        assert violations(tables[name], CONTRACTS[name], tables[name].columns[0]).count() == 0, name
    more = tables["trend_series"].selectExpr("*", "1 AS extra")
    assert violations(more, CONTRACTS["trend_series"], "metric").count() == 1
    assert violations(more.drop("extra", "value"), CONTRACTS["trend_series"], "metric").count() == 1


def test_timelines_from_the_corpus_and_enrichment(spark, corpus):
    pages = spark.createDataFrame([(1, "https://shore.test/b", "<p>The Harbour Authority replied.</p>")], "page_id int, url string, html string")
    tables = build_dataset(corpus, request(scrape_articles=True), pages)
    trend = {(r.bucket_start.hour, r.value, r.norm, r.source) for r in tables["trend_series"].collect()}
    assert trend == {(14, 2.0, 2.0, "corpus-timeline"), (15, 1.0, 2.0, "corpus-timeline")}
    assert tables["sentiment_source"].first().sentiment_source == "corpus-timeline"
    totals = tables["enrichment"].first()
    assert (totals.attempted, totals.succeeded, totals.failed) == (2, 1, 1)
    assert [r.error for r in tables["enrichment_errors"].collect()] == ["https://shore.test/A: page not found"]
    found = {r.url[-1]: r.matched_entities for r in tables["articles"].collect()}
    assert found == {"A": [], "b": ["Harbour Authority"]}
    with pytest.raises(ValueError, match="landed pages"):
        build_dataset(corpus, request(scrape_articles=True))


def test_all_tables_can_be_written(spark, corpus, tmp_path):
    tables = build_dataset(corpus, request())
    write_sections(tables, str(tmp_path), "json")
    assert {p.name for p in tmp_path.iterdir()} == set(tables)
    trend = spark.read.text(str(tmp_path / "trend_series"))
    assert violations(trend, CONTRACTS["trend_series"], "value", json="value").count() == 0
    windows = spark.read.text(str(tmp_path / "windows"))
    assert violations(windows, CONTRACTS["windows"], "value", json="value").count() == 0


def test_without_deduplication(corpus):
    tables = build_dataset(corpus, request(deduplicate=False, include_timeline=False))
    assert tables["articles"].count() == 3 and tables["coverage"].first().duplicates_removed == 0


def test_full_text_is_searched_but_not_carried(raw):
    rows = raw(dict(url="https://x/1", title="t", seendate="20260416T144500Z")).selectExpr("*", "'long river ferry text' AS text")
    tables = build_dataset(rows, request(), staged=False)
    assert tables["articles"].count() == 1
    assert "text" not in tables["articles"].columns and "ferry" not in tables["articles"].first().raw


def test_quality_report_in_a_folder_holds_no_plans_of_its_tables(corpus, tmp_path):
    asked = request(filters=Filters(keywords=["river ferry"]))
    with build_dataset(corpus, asked, folder=str(tmp_path)) as tables:
        plan = tables["quality"]._jdf.queryExecution().optimizedPlan().toString()
        assert not any(node in plan for node in ("Join", "Aggregate", "Window", "Sort"))
        found = {r.contract: (r.records_checked, r.records_bad) for r in tables["quality"].collect()}
    assert found["articles"] == (2, 0) and found["summary"] == (1, 0) and not any(bad for _, bad in found.values())
