from __future__ import annotations

from datetime import date

import pytest

from pressgrid import (
    Filters, Request, TimeRange, build_dataset, dedup_articles, extract_pages, land_articles, normalize_articles, normalize_timeline,
    read_articles, read_corpus, read_pages, read_timeline, select_articles, write_articles_csv, write_sections,
)
from pressgrid.plans.contracts import ARTICLE
from pressgrid.operators.quality import violations
from pressgrid.operators.windows import adaptive_windows, assign_windows, collect_articles, window_tree
from pressgrid.sources import stage, with_seen_at


def test_articles_from_response_files(spark, tmp_path):
    first = """{"articles": [
      {"url": "https://e/1", "title": "Ünï", "seendate": "20260416T144500Z", "tone": 1.5, "themes": ["A"],
       "scraped": {"status": "ok", "success": true, "text": "t"}}, {"url": "https://e/2"}]}"""
    second = '{"articles": [{"url": "https://e/2"}, {"url": "https://e/3", "unknown": 1}]}'
    for number, body in enumerate((first, second, '{"articles": []}', "{}"), 1):
        (tmp_path / f"w{number}.json").write_bytes(body.encode())
    rows = read_articles(spark, str(tmp_path))
    got = sorted((r.window_index, r.position, r.url[-1]) for r in rows.collect())
    assert got == [(0, 0, "1"), (0, 1, "2"), (1, 0, "2"), (1, 1, "3")]
    kept = dedup_articles(rows)
    assert sorted((r.window_index, r.url[-1]) for r in kept.collect()) == [(0, "1"), (0, "2"), (1, "3")]
    first = normalize_articles(kept, ["ünï"]).filter("title IS NOT NULL").first()
    assert first.matched_keywords == ["ünï"] and first.scrape_status == "ok" and first.scraped_text == "t"
    kept.write.parquet(str(tmp_path / "table"))
    assert read_articles(spark, str(tmp_path / "table"), "parquet").count() == 3


def test_timeline_files(spark, tmp_path):
    (tmp_path / "t.json").write_bytes(b"""{"query": "x", "timeline": [
      {"date": "20260416001000", "value": 2, "norm": 20}, {"date": "20260416", "value": true, "label": "L"},
      {"datetime": "20260416", "count": "3.5"}, {"date": "20260416", "value": ""}], "other": [{"date": "x", "value": 1}]}""")
    rows = normalize_timeline(read_timeline(spark, str(tmp_path)), "m")
    assert sorted((r.value, r.norm, r.label) for r in rows.collect()) == [(1.0, None, "L"), (2.0, 20.0, None), (3.5, None, None)]
    assert normalize_timeline(read_timeline(spark, str(tmp_path), ["absent", "other"]), "m").count() == 1
    assert read_timeline(spark, str(tmp_path), ["absent", "query"]).count() == 0


def test_pages_from_files(spark, tmp_path):
    (tmp_path / "a.html").write_bytes("<title>é</title>".encode())
    (tmp_path / "b.html").write_bytes(b"<title>\xe9</title>")
    read = extract_pages(read_pages(spark, str(tmp_path), "files"))
    assert sorted(r.title for r in read.collect()) == ["é", "�"]


def test_csv_round_trip(spark, tmp_path, raw):
    rows = normalize_articles(raw(
        dict(title='say "hi", you\nthere', url="https://é", seendate="20260416T144500Z"), dict(title="plain")), ["hi", "you"], ["say"])
    write_articles_csv(rows, str(tmp_path / "csv"))
    back = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path / "csv"))
    plain, said = back.orderBy("title").collect()
    assert (plain.title, plain.url) == ("plain", None)
    assert (said.title, said.url) == ('say "hi", you\nthere', "https://é") and said.matched_keywords == "hi | you | say"
    assert len(back.columns) == 19


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_sections_round_trip(spark, tmp_path, raw, fmt):
    rows = normalize_articles(raw(dict(title="Ünï", seendate="20260416T144500Z"))).drop("window_index", "position")
    write_sections({"articles": rows, "more": rows.select("title")}, str(tmp_path / "deep" / "out"), fmt)
    where = str(tmp_path / "deep" / "out" / "articles")
    if fmt == "parquet":
        assert spark.read.parquet(where).collect() == rows.collect()
    else:
        line = spark.read.text(where)
        assert "Ünï" in line.first().value and '"seen_at":"2026-04-16T14:45:00Z"' in line.first().value
        assert violations(line, ARTICLE, "value", json="value").count() == 0
        back = spark.read.schema(rows.drop("raw").schema).json(where)
        assert back.collect() == rows.drop("raw").collect()


def test_landed_corpus_is_pruned_by_day(spark, tmp_path, raw):
    rows = with_seen_at(raw(*(dict(title=f"t{d}", seendate=f"202601{d:02}T120000Z") for d in range(1, 11))))
    land_articles(rows, str(tmp_path / "corpus"))
    corpus = read_corpus(spark, str(tmp_path / "corpus"))
    found = select_articles(corpus, Filters(keywords=["t"]), TimeRange("2026-01-03", "2026-01-05T11:00:00Z"))
    assert sorted(r.seen_date for r in found.collect()) == [date(2026, 1, 3), date(2026, 1, 4)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(seen_date" in plan and "PushedFilters: [IsNotNull(seen_at)" in plan
    days = TimeRange("2026-01-03", "2026-01-05T11:00:00Z")
    request = Request(filters=Filters(keywords=["t"]), date_range=days)
    for rows in (
        assign_windows(corpus, days), adaptive_windows(corpus, days, 24, 5), window_tree(corpus, days, 24, 5),
        collect_articles(corpus, days, 24, 5), build_dataset(corpus, request, staged=False)["trend_series"],
    ):
        scans = [x for x in rows._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
        assert scans and all("PartitionFilters: [isnotnull(seen_date" in x for x in scans)


def test_stage_uses_the_named_folder(spark, tmp_path, raw):
    rows = raw(dict(title="a"), dict(title="b"))
    staged = stage(rows, "part", str(tmp_path))
    assert staged.schema == rows.schema and sorted(r.title for r in staged.collect()) == ["a", "b"]
    assert list(tmp_path.glob("pressgrid-*/part/*.parquet"))
