from __future__ import annotations

import pyarrow as pa
import pytest

from pressgrid import enrich_articles, enrichment_errors, enrichment_summary, extract_pages, normalize_articles
from pressgrid.operators.pages import _read_batches

STORY = """
<html lang="da"><head>
<meta property="article:published_time" content="2031-02-03T04:05:06Z"><title>Ferry returns to Oldport</title>
<link rel="canonical" href="https://shore.test/ferry"><meta name="description" content="A short note on boats.">
</head><body><div><p>The river ferry sails again.</p><p>Tickets cost two crowns.</p></div></body></html>
"""


@pytest.fixture
def read(spark):
    def run(html, **columns):
        pages = spark.createDataFrame([(1, html)], "page_id int, html " + ("binary" if isinstance(html, bytes) else "string"))
        for name, value in columns.items():
            from pyspark.sql import functions as F

            pages = pages.withColumn(name, F.lit(value))
        return extract_pages(pages).first()

    return run


def test_story(read):
    got = read(STORY)
    assert (got.title, got.language, got.published_at) == ("Ferry returns to Oldport", "da", "2031-02-03T04:05:06Z")
    assert got.description == "A short note on boats."
    assert got.canonical_url == "https://shore.test/ferry"
    assert got.text == "The river ferry sails again.\n\nTickets cost two crowns."
    assert got.excerpt == got.text and got.text_length == len(got.text)
    assert (got.status, got.success, got.error) == ("ok", True, None)


@pytest.mark.parametrize("html,text", [
    ("<body><p>one<p>two</p>", "two"),  # an unclosed paragraph is given up
    ("<body><p>a<br>b<br/>c</p>", "a b c"),
    ("<body><p> a \n  b  </p><p>   </p><p>c</p>", "a b\n\nc"),
    ("<body><p>x<script>var p='</p>';</script>y</p>", "xy"),
    ("<body><p>x<style>p{}</style><noscript>no</noscript>y</p>", "xy"),
    ("<body>just <b>body</b>\n text<script>no</script></body> after", "just body text"),
    ("<body>unclosed body", "unclosed body"),
    ("<div>no body at all</div>", None),
    ("<p>outside body</p>", "outside body"),
    ("<body>&lt;a&gt; &amp; &eacute;&nbsp;x</body>", "<a> & é x"),
    ("<body><p>a</p></body></noscript><p>b</p>", "a\n\nb"),
    ("", None),
])
def test_text_rules(read, html, text):
    got = read(html)
    assert got.text == text and got.text_length == len(text or "")


def test_metadata_rules(read):
    got = read(
        '<html lang="en"><html lang=" fr "><html lang="">'
        '<meta NAME=" Description " content="d"><meta property="og:description" content="  ">'
        '<meta name="twitter:description" content="t"><meta name="date" content="2020"><meta name="pubdate" content="2021">'
        '<meta property="og:title" content="Graph"><meta name="twitter:title" content="Bird">'
        '<link rel="Canonical alternate" href="/one"><link rel="canonical" href=" /two "><link rel="canonical">'
        '<meta http-equiv="og:pubdate" content="2022"><meta name="description" content="">'
    )
    assert (got.language, got.description, got.published_at) == ("fr", "d", "2021")
    assert (got.title, got.canonical_url) == ("Graph", "/two")
    assert read("<title> </title><meta name='twitter:title' content='Bird'>").title == "Bird"
    assert read("<title> Own \n title</title><meta property='og:title' content='Graph'>").title == "Own title"
    last = read("<meta name='description' content='a'><meta name='description' content='b'>")
    assert last.description == "b"
    assert read("<meta property='x' name='description' content='a'>").description is None


def test_excerpt_counts_code_points(read):
    exact, longer = "😀" * 280, "é" * 279 + " x"
    assert read(f"<p>{exact}</p>").excerpt == exact
    got = read(f"<p>{longer}</p>")
    assert got.text_length == 281 and got.excerpt == "é" * 279 + "..."


def test_bytes_are_decoded(read):
    assert read("<p>é</p>".encode()).text == "é"
    assert read("<p>é</p>".encode("latin-1")).text == "�"
    assert read("<p>é</p>".encode("latin-1"), charset="iso-8859-1").text == "é"
    wrong = read(b"<p>x</p>", charset="no-such-charset")
    assert wrong.status == "error" and not wrong.success and "no-such-charset" in wrong.error and wrong.text is None


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [(1, " https://a/1 ", STORY), (2, "https://a/2", "<p>two</p>"), (3, "https://a/1", "<p>later copy</p>"),
         (4, "https://never/asked", "<p>x</p>"), (5, "https://a/5", None)],
        "page_id int, url string, html string",
    )


def test_enrichment(raw, pages):
    rows = raw(
        dict(url="https://a/1", title="one"), dict(url=None, title="none"), dict(url="https://a/2 ", title="two"),
        dict(url="https://gone", title="gone"), dict(url="https://a/5", title="unread"), dict(url="  ", title="blank"),
    )
    found = enrich_articles(rows, pages)
    assert found.count() == 6
    state = {r.title: (r.scraped.status, r.scraped.error) for r in found.collect()}
    assert state == {
        "one": ("ok", None), "two": ("ok", None), "none": ("skipped", "missing url"), "blank": ("skipped", "missing url"),
        "gone": ("error", "page not found"), "unread": ("error", "page has no content"),
    }
    one = found.filter("title = 'one'").first().scraped
    assert one.title == "Ferry returns to Oldport" and one.final_url == "https://a/1" and one.requested_url == "https://a/1"
    totals = enrichment_summary(found).first()
    assert (totals.requested, totals.attempted, totals.succeeded, totals.failed, totals.skipped) == (True, 4, 2, 2, 2)
    assert sorted(r.error for r in enrichment_errors(found).collect()) == [
        "https://a/5: page has no content", "https://gone: page not found"]
    done = normalize_articles(found, ["river ferry sails"])
    assert tuple(enrichment_summary(done).first()) == tuple(totals)
    assert done.filter("title = 'one'").first().matched_keywords == ["river ferry sails"]


def test_limit_counts_rows_without_address(raw, pages):
    rows = raw(
        dict(url="https://a/2", seendate="20260101T000000Z"), dict(url=None, seendate="20260104T000000Z"),
        dict(url="https://a/1", seendate="20260103T000000Z"), dict(url="https://gone", seendate="20260102T000000Z"),
    )
    found = enrich_articles(rows, pages, limit=2, sort="DateDesc").orderBy("position").collect()
    assert [r.scraped and r.scraped.status for r in found] == [None, "skipped", "ok", None]
    totals = enrichment_summary(enrich_articles(rows, pages, limit=2, sort="DateDesc"), 2).first()
    assert (totals.attempted, totals.succeeded, totals.failed, totals.skipped, totals.limit) == (1, 1, 0, 3, 2)
    off = enrichment_summary(rows, 7, requested=False).first()
    assert tuple(off) == (False, 0, 0, 0, 0, 7)


def test_limit_one_golden(raw, pages):
    totals = enrichment_summary(enrich_articles(raw(dict(url="https://a/1")), pages, 1), 1).first()
    assert (totals.attempted, totals.succeeded) == (1, 1)


def test_copies_of_one_address(spark, raw):
    """A third of all pages share an address, some of them even their number."""
    copies = [(i // 2, "https://hot" if i % 3 == 0 else f"https://x/{i}", f"<p>{i // 2}</p>") for i in range(900)]
    pages = spark.createDataFrame(copies, "page_id int, url string, html string").repartition(8)
    rows = raw(*(dict(url="https://hot") for _ in range(40)), dict(url="https://x/1"))
    found = enrich_articles(rows, pages).collect()
    assert len(found) == 41 and {r.scraped.text for r in found} == {"0"}


def test_first_readable_copy(spark, raw):
    """A copy without HTML does not hide a later one; nulls of the order come last."""
    pages = spark.createDataFrame(
        [(1, "https://a", None), (2, "https://a", "<p>second</p>"), (None, "https://b", "<p>b</p>"), (None, "https://b", "<p>a</p>"),
         (3, "https://c", None), (None, "https://c", None)], "page_id int, url string, html string")
    rows = raw(*(dict(url=f"https://{x}", title=x) for x in "abc"))
    found = {r.title: (r.scraped.status, r.scraped.text) for r in enrich_articles(rows, pages).collect()}
    assert found == {"a": ("ok", "second"), "b": ("ok", "a"), "c": ("error", None)}
    assert extract_pages(pages).count() == 6


def test_python_holds_the_pieces_of_a_slice_not_of_a_batch():
    pages = [f"<p>{i} {'x' * 400_000}</p>" for i in range(7)] + [None, "<p>" + "y" * 3_000_000 + "</p>", "<p>last</p>"]
    batch = pa.RecordBatch.from_pydict({
        "page_id": range(10), "_html": pages, "_charset": pa.nulls(10, pa.string()),
    })
    for rows in (batch, batch.slice(0, 0)):
        parts = list(_read_batches(iter([rows])))
        assert [i for part in parts for i in part["page_id"].to_pylist()] == list(range(rows.num_rows))
        assert all(part.num_rows <= 3 for part in parts) and (len(parts) > 4 or not rows.num_rows)
    found = pa.Table.from_batches(list(_read_batches(iter([batch])))).to_pylist()
    assert [len(row["_paragraphs"][0]) if row["_paragraphs"] else row["_error"] for row in found] == (
        [400_002] * 7 + ["page has no content", 3_000_000, 4]
    )
