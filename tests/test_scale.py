"""What has to hold when groups are large: caps, limits, crowded addresses, tables of terms, owned steps."""

from __future__ import annotations

import random
import re
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from pressgrid import Filters, Request, Sort, TimeRange, build_dataset, cap_per_window, collect_articles, enrich_articles
from pressgrid.operators.articles import match_term_table, match_terms
from pressgrid.operators.pages import first_articles
from pressgrid.operators.places import numbered
from pressgrid.operators.quality import violations
from pressgrid.operators.summary import ranked_counts
from pressgrid.operators.windows import order_key, remote_order
from pressgrid.sources import Stages, read_articles, read_timeline

FOLDER = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.fixture
def stages():
    with Stages() as owner:
        yield owner


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def operators(rows):
    found = re.findall(r"^[\s:+-]*(?:\*\(\d+\) )?([A-Z]\w+)", plan(rows), re.M)
    return [name for name in found if name != "WindowGroupLimit"]


def largest_share(rows):
    """Rows of the largest partition against the median one."""
    sizes = sorted(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
    return sizes[-1] / sizes[len(sizes) // 2]


# --- places and caps ---


def test_numbered(spark, stages):
    values = [random.Random(2).choice("abc") for _ in range(500)] + [None] * 40
    rows = spark.createDataFrame(list(enumerate(values)), "id long, g string").repartition(7)
    found = numbered(rows, [F.desc("id")], stages.keep, ["g"], total="size").collect()
    for group in ("a", "b", "c", None):
        ids = sorted((i for i, g in enumerate(values) if g == group), reverse=True)
        assert {r.id: (r.place, r.size) for r in found if r.g == group} == {i: (at, len(ids)) for at, i in enumerate(ids)}
    assert sorted(r.place for r in numbered(rows, [F.asc("id")], stages.keep).collect()) == list(range(540))
    assert numbered(rows.limit(0), [F.asc("id")], stages.keep).count() == 0


@pytest.mark.parametrize("sort", list(Sort))
def test_caps_against_a_sorted_list(spark, stages, sort):
    """A third of all rows in one second with one tone, nulls, and window sizes around the cap."""
    pick = random.Random(4)
    rows = [
        (i, pick.randrange(3), *((100, 1.5) if i % 3 == 0 else (pick.choice([None, *range(90, 110), 10**6]), pick.choice([None, 1.5, -7.25, 1e300, float("nan")]))))
        for i in range(600)
    ]
    frame = spark.createDataFrame(
        [(i, w, None if s is None else START + timedelta(seconds=s), t) for i, w, s, t in rows], "id int, w int, seen_at timestamp, tone double"
    ).repartition(5)
    order = remote_order(sort, tie=("id",))

    def place(row):
        i, _, second, tone = row
        nan = tone is not None and tone != tone
        return {
            Sort.OLDEST: (second is not None, second or 0, i),
            Sort.TONE_HIGH: (tone is None, not nan, 0 if tone is None or nan else -tone, i),
            Sort.TONE_LOW: (tone is None, nan, 0 if tone is None or nan else tone, i),
        }.get(sort, (second is None, -(second or 0), i))

    for cap in (1, 50, 199, 200, 5000, None):
        found = cap_per_window(frame, cap, order, ("w",), order_key(sort), stages).collect()
        expected = {}
        for window in range(3):
            inside = sorted((r for r in rows if r[1] == window), key=place)[:cap]
            expected |= {r[0]: (window, at) for at, r in enumerate(inside)}
        assert {r.id: (r.w, r.position) for r in found} == expected, cap


def test_one_plan_for_every_cap(spark):
    rows = spark.range(100).select("id", F.lit(1).alias("w"), F.current_timestamp().alias("seen_at"))

    def capped(cap):
        return cap_per_window(rows, cap, [F.asc("id")], ("w",), F.unix_seconds("seen_at"))

    assert operators(capped(75)) == operators(capped(5000))
    assert "SPARK_PARTITION_ID" not in plan(capped(5000)) and "Window" in operators(capped(75))


def test_window_tree_needs_two_exchanges_of_seconds(spark):
    rows = QUERIES["adaptive_windows"](spark, FOLDER)
    rows.collect()
    executed = plan(rows).split("== Initial Plan ==")[0]
    lines = [line for line in executed.split("\n") if re.search(r"Exchange hashpartitioning\(base#\d+, second#\d+L", line)]
    assert 1 <= sum("Reused" not in line for line in lines) <= 2


def test_no_cap_keeps_a_relative_range(spark, stages):
    rows = spark.range(3000).select("id", (F.lit(START) + F.expr("make_interval(0,0,0,0,0,0,id % 1000)")).alias("seen_at"), F.lit("u").alias("url"))
    span = TimeRange(timespan="1h", as_of=START + timedelta(seconds=999))
    found = collect_articles(rows, span, 24, None, Sort.OLDEST, tie=("id",), stages=stages)
    assert [r.id for r in found.orderBy("position").collect()] == sorted(range(3000), key=lambda i: (i % 1000, i))
    assert Request(filters=Filters(keywords=["x"])).max_records is None


# --- tables of terms ---


def test_term_table_agrees_with_match_terms(spark, stages):
    pick = random.Random(8)
    texts = [" ".join("".join(pick.choice("abßé") for _ in range(pick.randint(0, 4))) for _ in range(pick.randint(0, 9))) for _ in range(200)]
    texts += [None, "", "STRASSE ünd", "x" * 1000 + "Needle" + "y" * 1000, "of the of", "a\nb c"]
    terms = ["a", "AB", "b a", "éé", " aß b ", "Straße", "needle", "xy", "xneedle", "the of", "f the o", "a  b", "\nb", "absent", "", None, "a", " "]
    terms += ["".join(pick.choice("abé ") for _ in range(5)) for _ in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    wanted = spark.createDataFrame([(t, 1) for t in terms], "term string, other int")
    found = match_term_table(rows, wanted, F.col("text"), "id", stages=stages)
    few = list(dict.fromkeys(t.strip() for t in terms if t and t.strip()))
    expected = rows.select("id", F.explode(match_terms(F.col("text"), few)).alias("term"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert match_term_table(rows.limit(0), wanted, F.col("text"), "id", stages=stages).count() == 0
    assert match_term_table(rows, wanted.limit(0), F.col("text"), "id", stages=stages).count() == 0


def test_term_table_shuffles_no_matches(spark, stages):
    pick = random.Random(9)
    words = ["".join(pick.choice("abß\U0001f600é") for _ in range(pick.randint(1, 9))) for _ in range(30)]
    texts = [pick.choice((" ", "\n", "")).join(pick.choices(words, k=40)) for _ in range(60)]
    texts += [None, "", " ", "x" * 70_000 + "straSSe 7" + "y" * 70_000, "x" * 65_533 + "Needle" + "y" * 9]
    terms = ["needle", *words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)), "Straße", "e 7", "7y", "absent", None, " "]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    wanted = spark.createDataFrame([(t,) for t in terms], "term string")
    held = match_term_table(rows, wanted, F.col("text"), "id", stages=stages)
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", plan(held))
    assert shuffles.count("_id") == 1 and "word" not in shuffles and "SortMergeJoin" not in plan(held).split("BroadcastExchange")[0]
    few = list(dict.fromkeys(t.strip() for t in terms if t and t.strip()))
    expected = sorted(map(tuple, rows.select("id", F.explode(match_terms(F.col("text"), few))).collect()))
    assert sorted(map(tuple, held.collect())) == expected and len(expected) > 1000
    indexed = match_term_table(rows, wanted, F.col("text"), "id", stages=stages, held_bytes=0)
    assert "word" in re.findall(r"Exchange hashpartitioning\((\w+)#", plan(indexed))
    assert sorted(map(tuple, indexed.collect())) == expected


# --- enrichment ---


def test_crowded_address_is_dealt_out(spark, raw, stages):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("https://hot/")).otherwise(F.concat(F.lit("https://x/"), F.col("id") % 500)).alias("url"),
        F.lit("t").alias("title"), F.lit("20240101T000000Z").alias("seendate"), F.lit(0.0).alias("tone"),
        F.lit(0).alias("window_index"), F.col("id").cast("int").alias("position"),
    )
    pages = spark.createDataFrame([(1, "https://hot/", "<p>hot</p>"), (2, "https://x/7", "<p>seven</p>")], "page_id int, url string, html string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "6"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        dealt = enrich_articles(rows, pages, crowd=20)
        assert largest_share(dealt) <= 2
        assert largest_share(enrich_articles(rows, pages, crowd=10**6)) > 2
        counts = {r.text: r["count"] for r in dealt.groupBy(F.col("scraped.text").alias("text")).count().collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert counts == {"hot": 1000, "seven": sum(i % 3 != 0 and i % 500 == 7 for i in range(3000)), None: 2000 - sum(i % 3 != 0 and i % 500 == 7 for i in range(3000))}


def test_limit_gathers_nothing(spark, raw, stages):
    rows = raw(*(dict(url=f"https://e/{i}", seendate=f"202601{1 + i % 20:02}T000000Z", tone=float(i % 7), window_index=i // 10, position=i % 10) for i in range(200)))
    for sort in Sort:
        found = {r[0] for r in first_articles(rows, 90, sort, stages).collect()}
        from pressgrid import sort_articles
        wanted = sort_articles(rows, sort).limit(90).collect()
        assert found == {(r.window_index << 32) + r.position for r in wanted}
    for name in ("enrich_limit", "enrich_half"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert "TakeOrderedAndProject" not in text and "GlobalLimit" not in text


# --- ranks, JSON, readers ---


def test_two_hundred_thousand_entities(spark):
    rows = spark.range(400_000).select(
        (F.col("id") % 200_000).cast("string").alias("entity"), F.lit(7).alias("article"), F.col("id").alias("at")
    ).repartition(8)
    best = ranked_counts(rows, "entity", ("article", "at"))
    assert [(r.value, r["count"], r.first_at) for r in best.limit(3).collect()] == [(str(i), 2, [7, i]) for i in range(3)]
    assert best.filter("value = '199999'").first().first_at == [7, 199_999]


@pytest.mark.parametrize("number,kind", [
    ("12345678901234567890.0", "number"), ("12345678901234567890", "integer"), ("1e3", "number"), ("1.0", "number"), ("-0", "integer"),
    ("9" * 45, "integer"), ("9" * 45 + ".5", "number"), ("1E400", "number"), ("0.5", "number"), (" 7 ", "integer"), ("1000000000000000000.0", "number"),
])
def test_number_types(spark, number, kind):
    contract = {"type": "object", "properties": {"a": {"type": "string"}, "b": {"type": "array", "items": {"type": "string"}}}}
    rows = spark.createDataFrame([(f'{{"a":{number},"b":["x",{number}]}}',)], "line string")
    found = {r.path: r.detail for r in violations(rows, contract, "line", json="line").collect()}
    assert found == {"$.a": f"expected string, got {kind}", "$.b[1]": f"expected string, got {kind}"}
    (alone,) = violations(spark.createDataFrame([(number,)], "line string"), {"type": "string"}, "line", json="line").collect()
    assert alone.detail == f"expected string, got {kind}"


def test_first_list_of_objects(spark, tmp_path):
    bodies = [
        '{"z": 1, "y": ["a"], "x": [{"date": "1"}], "a": [{"date": "2"}]}',  # fields in the order written, not sorted
        '{"q": [], "a": [{"date": "3"}]}',  # an empty list comes first and has no points
        '{"q": [{"date": "4"}, 5], "m": {"date": "6"}, "n": [{"date": "7", "value": true}]}',
        "[1]", "null", "", "{", '{"a": [{"date": "8"}], "a": [{"date": "9"}]}',
    ]
    for number, body in enumerate(bodies):
        (tmp_path / f"{number}.json").write_text(body)
    assert sorted((r.date, r.value) for r in read_timeline(spark, str(tmp_path)).collect()) == [("1", None), ("7", "1")]
    assert sorted(r.date for r in read_timeline(spark, str(tmp_path), ["a", "x"]).collect()) == ["2", "3"]


def test_files_are_numbered_by_ranges(spark, tmp_path, stages):
    for number in range(40):
        (tmp_path / f"{number:03}.json").write_text('{"articles": [{"title": "%d"}]}' % number)
    rows = read_articles(spark, str(tmp_path), stages=stages)
    assert sorted((r.window_index, r.title) for r in rows.collect()) == sorted((n, str(n)) for n in range(40))
    assert "Window" not in operators(rows)


# --- datasets that own their steps ---


def jobs(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_naming_a_table_starts_no_job(spark, raw, tmp_path):
    rows = raw(*(dict(url=f"https://e/{i % 9}", title="river ferry", seendate=f"20260416T10{i:02}00Z", domain="e") for i in range(20)))
    asked = Request(filters=Filters(keywords=["ferry"]), date_range=TimeRange("2026-04-15", "2026-04-17"), max_records=5)
    spark.sparkContext.setJobGroup("naming", "tables named")
    with build_dataset(rows, asked) as tables:
        for name in tables:
            tables[name]
        assert jobs(spark, "naming") == 0
        assert tables["summary"].first().article_count == 9 and jobs(spark, "naming") > 0
        held = tables._builders and tables.stages._held
        assert held and all(step.is_cached for step in held)
        kept = list(held)
    assert not any(step.is_cached for step in kept)
    spark.sparkContext.setJobGroup("other", "other")
    with build_dataset(rows, asked, folder=str(tmp_path)) as tables:
        assert tables["summary"].first().article_count == 9
        assert list(tmp_path.rglob("*.parquet"))
    assert not list(tmp_path.rglob("*.parquet"))
