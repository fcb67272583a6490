"""Every operator as a query over the given tables: name -> function of (session, folder)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog import views
from pressgrid.functions.numbers import to_number
from pressgrid.functions.times import compact_second, iso_utc
from pressgrid.operators import articles as art
from pressgrid.operators import dedup, pages, predicates, quality, series, summary, windows
from pressgrid.operators.predicates import CORPUS_TEXT
from pressgrid.plans.contracts import CONTRACTS
from pressgrid.plans.dataset import build_dataset
from pressgrid.plans.request import Filters, Near, Request, Sort, TimeRange
from pressgrid.schemas import SERIES
from pressgrid.sources import (
    flatten_articles,
    land_articles,
    read_articles,
    read_corpus,
    read_pages,
    read_timeline,
    shared_folder,
    stage,
    write_articles_csv,
    write_sections,
)
from pressgrid.sources.writers import FLAT_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

# Terms that occur in the given documents, in mixed case.
KEYWORDS = ("And The", "eaux", "LICENSE", "absentterm")
PHRASES = ("tion and",)
ENTITIES = ("Nation 7", "für", "the the", "nation 1")
JANUARY = TimeRange("2024-01-01", "2024-01-31")
MAX_ROWS = 100

FILTERS: dict[str, Filters] = {
    "filter_any": Filters(keywords=("eaux", "LICENSE"), exact_phrases=("and the",), entities=("Nation 7",)),
    "filter_all": Filters(keywords=("the", "tion"), exact_phrases=("of the",), match_mode="all"),
    "filter_keyword": Filters(keywords=("Eaux",)),
    "filter_phrase": Filters(exact_phrases=('"Tion And"',)),
    "filter_entity": Filters(entities=("Nation 3", "nation 21")),
    "filter_theme": Filters(themes=("LANG_DE", "SRC_SRC3")),
    "filter_prefix": Filters(keywords=("theme:LANG_FR", "sourcecountry:nation 9", "domain:src5.example.com")),
    "filter_country_lang": Filters(source_countries=("Nation 3", " nation  12 "), source_languages=("EN", "de")),
    "filter_domain": Filters(domains=("example.com",), exclude_terms=("sourcelang:fr",)),
    "filter_exact_domain": Filters(exact_domains=("src1.example.com", "SRC2.example.com")),
    "filter_tone": Filters(tone_min=-2.5, tone_max=4.0),
    "filter_tone_abs": Filters(tone_abs_min=3.0, tone_abs_max=8.0),
    "filter_proximity": Filters(proximity=(Near(3, ("and", "The")),)),
    "filter_proximity_three": Filters(proximity=(Near(6, ("and", "the", "of")),)),
    "filter_repeat": Filters(repeated_terms={"The": 5}),
    "filter_repeat_phrase": Filters(repeated_terms={"of the": 2}),
    "filter_exclude": Filters(source_languages=("en",), exclude_terms=("-the", "license", "of the")),
}


def _filter(spec: Filters) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        found = predicates.select_articles(views.corpus(spark, folder), spec, text_columns=CORPUS_TEXT)
        return found.select("doc_id", "domain", "language")

    return run


def _in_range(spark: SparkSession, folder: str) -> DataFrame:
    found = views.corpus(spark, folder).filter(predicates.in_range(TimeRange("2024-01-05", "2024-01-12T06:30:00Z")))
    return found.select("doc_id", iso_utc(F.col("seen_at")).alias("seen_at"))


def _in_span(spark: SparkSession, folder: str) -> DataFrame:
    found = views.feed(spark, folder).filter(
        predicates.in_range(TimeRange(timespan="7days", as_of="2024-01-20T12:00:00Z"))
    )
    return found.select("event_id", iso_utc(F.col("seen_at")).alias("seen_at"))


def _compact_times(spark: SparkSession, folder: str) -> DataFrame:
    return views.feed(spark, folder).select("event_id", compact_second(F.col("seen_at")).alias("second"))


def _text_series(rows: DataFrame, *extra: str) -> DataFrame:
    """A series in comparable form: times as text, doubles rounded."""
    return rows.select(
        iso_utc(F.col("bucket_start")).alias("bucket_start"), F.round("value", 6).alias("value"), "metric",
        F.round("norm", 6).alias("norm"), "label", *extra,
    )


def _volume(size: str) -> Query:
    return lambda spark, folder: _text_series(series.volume_series(views.feed(spark, folder), size))


def _joined(*names: str) -> list[Column]:
    return [F.array_join(name, " | ").alias(name) for name in names]


def _normalize(spark: SparkSession, folder: str) -> DataFrame:
    done = art.normalize_articles(
        views.read_corpus_as_pages(spark, folder), KEYWORDS, PHRASES, ENTITIES, ("ENV", "ECON")
    )
    return done.select(
        "article_id", "title", "url", "mobile_url", iso_utc(F.col("seen_at")).alias("seen_at"), "domain",
        "language", "source_country", "social_image_url",
        *_joined("matched_keywords", "matched_entities", "requested_themes"),
        "scrape_status", "scrape_success", "scrape_error", "scraped_title", "scraped_text",
        "scraped_text_length", F.get_json_object("raw", "$.url").alias("raw_url"),
        "window_index", "position",
    )


def _match_terms(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.corpus(spark, folder)
    space = predicates.match_space(CORPUS_TEXT)
    return rows.select(
        "doc_id", F.array_join(art.match_terms(space, (*KEYWORDS, *PHRASES)), " | ").alias("matched_keywords"),
        F.array_join(art.match_terms(space, ENTITIES), " | ").alias("matched_entities"),
    )


def _match_term_table(spark: SparkSession, folder: str) -> DataFrame:
    """All words of the benchmark items, and pairs of neighbouring ones, in all turns of conversations."""
    items = views.table(spark, folder, "benchmark").select(F.split("text", r"\s+").alias("words"))
    pairs = F.zip_with("words", F.slice("words", 2, F.size("words")), lambda a, b: F.concat_ws(" ", a, b))
    terms = items.select(F.explode(F.concat("words", pairs)).alias("term"))
    turns = views.table(spark, folder, "conversations").withColumn("turn_id", F.struct("conv_id", "turn"))
    found = art.match_term_table(turns, terms, F.col("text"), "turn_id")
    return found.groupBy("term").agg(F.count("*").alias("turns"), F.min("turn_id.conv_id").alias("first_conv"))


def _matched(spark: SparkSession, folder: str) -> DataFrame:
    return art.normalize_articles(views.read_corpus_as_pages(spark, folder), KEYWORDS, PHRASES, ENTITIES)


def _entity_tracking(size: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        found = series.entity_tracking(_matched(spark, folder), size)
        return found.withColumn("bucket_start", iso_utc(F.col("bucket_start")))

    return run


def _feed_articles(spark: SparkSession, folder: str) -> DataFrame:
    return art.normalize_articles(views.feed(spark, folder), entities=("Nation 7", "click", "nation 1", "click"))


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.select("value", "count", F.array_join(F.col("first_at").cast("array<string>"), "/").alias("first_at"))


def _rank(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _ranked(summary.rankings(_feed_articles(spark, folder))[name])

    return run


def _rank_newest(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked(summary.rankings(_feed_articles(spark, folder), Sort.NEWEST)["source_countries"])


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    raw = views.linked(spark, folder)
    raw = dedup.union_fetches([raw, raw.withColumn("window_index", F.col("window_index") + 1_000_000)])
    unique = dedup.dedup_articles(raw)
    enriched = pages.enrich_articles(unique, views.table(spark, folder, "pages"))
    return summary.dataset_summary(art.normalize_articles(enriched), raw)


def _union(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.feed(spark, folder).select("event_id", "url", "window_index", "position")
    return dedup.union_fetches([rows, rows.withColumn("window_index", F.col("window_index") + 1_000_000)])


def _dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.dedup_articles(views.feed(spark, folder)).select(
        "event_id", "url", "title", "seendate", "domain", "window_index", "position"
    )


def _dedup_counts(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.dedup_counts(views.feed(spark, folder))


def _sort(sort: Sort) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # A row's rank is its place in its sorted partition and the rows of the partitions before it.
        rows = stage(dedup.sort_articles(views.feed(spark, folder), sort).select(
            "event_id", "seendate", F.round("tone", 6).alias("tone"), "window_index", "position",
            F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % (1 << 33)).alias("place"),
        ), "sorted")
        counts = rows.groupBy("part").agg(F.count("*").alias("rows"))
        before = counts.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
        return rows.join(before, "part").withColumn("rank", F.col("before") + F.col("place") + 1).drop("part", "place", "before")

    return run


def _timeline(spark: SparkSession, folder: str) -> DataFrame:
    return _text_series(series.normalize_timeline(views.timeline(spark, folder), "article_count"))


def _rebucket(size: str, aggregation: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = series.normalize_timeline(views.timeline(spark, folder), "article_count")
        return _text_series(series.rebucket(rows, size, aggregation))

    return run


def _volume_timeline(spark: SparkSession, folder: str) -> DataFrame:
    hit = predicates.article_predicate(FILTERS["filter_any"], CORPUS_TEXT)
    return _text_series(series.volume_timeline(views.corpus(spark, folder), hit, "day"))


def _tone_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return _text_series(series.tone_timeline(views.feed(spark, folder), "hour"))


def _trend_supplied(spark: SparkSession, folder: str) -> DataFrame:
    points = series.normalize_timeline(views.timeline(spark, folder), "article_count")
    return _text_series(series.trend_series(views.corpus(spark, folder), points, "day"), "source")


def _trend_fallback(spark: SparkSession, folder: str) -> DataFrame:
    points = series.normalize_timeline(views.timeline(spark, folder).filter("event_id < 0"), "article_count")
    return _text_series(series.trend_series(views.feed(spark, folder), points, "hour"), "source")


def _sentiment(spark: SparkSession, folder: str) -> DataFrame:
    tone = series.tone_timeline(views.feed(spark, folder), "hour")
    return _text_series(series.sentiment_series(tone, "day"), "source")


def _series_source(spark: SparkSession, folder: str) -> DataFrame:
    points = series.normalize_timeline(views.timeline(spark, folder), "article_count")
    return series.series_source(points, series.SUPPLIED, series.FALLBACK, "trend_source")


def _targets(spark: SparkSession, folder: str) -> DataFrame:
    counts = series.volume_series(views.feed(spark, folder), "day").agg(F.count("*").alias("trend_rows"))
    return summary.analysis_targets(spark, ENTITIES, "day").select(
        "trend_metric", "sentiment_metric", *_joined("tracked_entities"), "bucket_size",
        counts.scalar().alias("trend_rows"),
    )


def _fixed_windows(spark: SparkSession, folder: str) -> DataFrame:
    kept = windows.assign_windows(views.feed(spark, folder), TimeRange("2024-01-02T05:00:00Z", "2024-01-30T17:00:00Z"), 36)
    grid = windows.fixed_windows(spark, TimeRange("2024-01-02T05:00:00Z", "2024-01-30T17:00:00Z"), 36)
    counts = kept.groupBy("index").agg(F.count("*").alias("articles"))
    return grid.join(counts, "index", "left").select(
        "index", iso_utc(F.col("start")).alias("start"), iso_utc(F.col("end")).alias("end"), "timespan",
        F.coalesce("articles", F.lit(0)).alias("articles"),
    )


def _adaptive_windows(spark: SparkSession, folder: str) -> DataFrame:
    return windows.adaptive_windows(views.feed(spark, folder), JANUARY, 24, MAX_ROWS).withColumns({
        "start": iso_utc(F.col("start")), "end": iso_utc(F.col("end")),
    })


def _collected(spark: SparkSession, folder: str, max_rows: int = MAX_ROWS) -> DataFrame:
    return windows.collect_articles(
        views.feed(spark, folder), JANUARY, 24, max_rows, Sort.NEWEST, tie=("event_id",)
    )


def _collect(max_rows: int) -> Query:
    return lambda spark, folder: _collected(spark, folder, max_rows).select("event_id", "window_index", "position")


def _capped(max_rows: int, hours: int | None) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = windows.assign_windows(views.feed(spark, folder), JANUARY, hours)
        order = windows.remote_order(Sort.TONE_HIGH, tie=("event_id",))
        key = windows.order_key(Sort.TONE_HIGH)
        return windows.cap_per_window(rows, max_rows, order, ("index",), key).select("event_id", "index", "position")

    return run


def _uncapped(spark: SparkSession, folder: str) -> DataFrame:
    """All articles of a relative range, which is one window."""
    week = TimeRange(timespan="7days", as_of="2024-01-20T12:00:00Z")
    rows = windows.collect_articles(views.feed(spark, folder), week, 24, None, Sort.NEWEST, tie=("event_id",))
    return rows.select("event_id", "window_index", "position")


def _coverage(spark: SparkSession, folder: str) -> DataFrame:
    tree = windows.window_tree(views.feed(spark, folder), JANUARY, 24, MAX_ROWS)
    return windows.coverage_summary(tree, dedup.dedup_articles(_collected(spark, folder)), MAX_ROWS)


def _warnings(spark: SparkSession, folder: str) -> DataFrame:
    tree = windows.window_tree(views.feed(spark, folder), JANUARY, 24, MAX_ROWS)
    return windows.coverage_warnings(tree, MAX_ROWS).select("split_depth", "message")


def _extract(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(views.table(spark, folder, "pages")).select(
        "page_id", "url", "status", "title", "description", "published_at", "language", "canonical_url",
        "text", "excerpt", "text_length",
    )


def _enriched(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    return pages.enrich_articles(
        views.linked(spark, folder), views.table(spark, folder, "pages"), limit, Sort.NEWEST
    )


def _enrich(limit: int | None) -> Query:
    return lambda spark, folder: _enriched(spark, folder, limit).select(
        "doc_id", "url",
        F.coalesce("scraped.status", F.lit("not_requested")).alias("scrape_status"),
        F.coalesce("scraped.success", F.lit(False)).alias("scrape_success"),
        F.col("scraped.error").alias("scrape_error"), F.col("scraped.final_url").alias("scraped_final_url"),
        F.col("scraped.language").alias("scraped_language"),
    )


def _enrich_summary(spark: SparkSession, folder: str) -> DataFrame:
    return pages.enrichment_summary(_enriched(spark, folder, 150), 150)


def _enrich_errors(spark: SparkSession, folder: str) -> DataFrame:
    return pages.enrichment_errors(_enriched(spark, folder))


def _extract_empty(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of which every 20th has no HTML."""
    rows = read_pages(spark, f"{folder}/pages.parquet")
    rows = rows.withColumn("html", F.when(F.col("page_id") % 20 != 0, F.col("html")))
    return pages.extract_pages(rows).select("page_id", "url", "status", "success", "error", "language")


def _enrich_crowded(spark: SparkSession, folder: str) -> DataFrame:
    """A third of all articles share the address of one page."""
    rows, found = views.linked(spark, folder), views.table(spark, folder, "pages")
    found = found.withColumn("fetched_at", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id")))
    one = found.agg(F.min("url")).scalar()
    shared = rows.withColumn("url", F.when(F.col("doc_id") % 3 == 0, one).otherwise(F.col("url")))
    return pages.enrich_articles(shared, found, crowd=1000).select(
        "doc_id", "url", F.col("scraped.status").alias("scrape_status"), F.col("scraped.final_url").alias("scraped_final_url"),
        F.col("scraped.language").alias("scraped_language"), iso_utc(F.col("scraped.fetched_at")).alias("fetched_at"),
    )


def _enrich_half(spark: SparkSession, folder: str) -> DataFrame:
    """A limit of half of all articles."""
    rows = views.linked(spark, folder)
    half = rows.count() // 2
    return pages.enrich_articles(rows, views.table(spark, folder, "pages"), half, Sort.NEWEST).select(
        "doc_id", F.coalesce("scraped.status", F.lit("not_requested")).alias("scrape_status")
    )


def _enrich_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Every 20th page without HTML, every tenth address with an earlier copy without HTML."""
    rows = views.table(spark, folder, "pages").select("page_id", "url", "html")
    rows = rows.withColumn("html", F.when(F.col("page_id") % 20 != 0, F.col("html")))
    copies = rows.filter("page_id % 10 = 0").select(
        (F.col("page_id") - (1 << 40)).alias("page_id"), "url", F.lit(None).cast("string").alias("html")
    )
    return pages.enrich_articles(views.linked(spark, folder), rows.unionByName(copies)).select(
        "doc_id", "url", F.col("scraped.status").alias("scrape_status"), F.col("scraped.error").alias("scrape_error")
    )


def _read_articles(spark: SparkSession, folder: str) -> DataFrame:
    """The feed as response files, one a window and named in their order, read back."""
    where = _target(spark, "responses")
    article = F.struct("position", "url", "title", "seendate", "domain", "language", "sourcecountry", "tone", "themes")
    responses = views.feed(spark, folder).groupBy("window_index").agg(F.sort_array(F.collect_list(article)).alias("articles"))
    named = responses.select(F.lpad(F.col("window_index").cast("string"), 10, "0").alias("name"), "articles")
    named.write.partitionBy("name").json(where)
    return read_articles(spark, where).select(
        "url", "title", "seendate", "domain", "language", "sourcecountry", F.round("tone", 6).alias("tone"), "window_index",
        "position",
    )


def _read_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Timeline points as payload files that hold other fields around them, and a second list behind them."""
    where = _target(spark, "payloads")
    points = F.collect_list(F.struct("event_id", "date", "value", "count", "norm"))
    payload = F.to_json(F.struct(
        F.lit("v1").alias("version"), F.array(F.lit("a"), F.lit("b")).alias("tags"), F.sort_array("points").alias("points"),
        F.array(F.struct(F.lit("20240101").alias("date"), F.lit(1).alias("value"))).alias("alternative"),
    ))
    grouped = views.timeline(spark, folder).groupBy((F.col("event_id") / 1000).cast("long").alias("file")).agg(points.alias("points"))
    grouped.select(payload.alias("value")).write.option("maxRecordsPerFile", 1).text(where)
    numbers = (F.round(to_number(F.col(name)), 6).alias(name) for name in ("value", "count", "norm"))
    return read_timeline(spark, where).select("date", *numbers)


def _landed_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of a few days of a corpus that is partitioned by day."""
    where = _target(spark, "corpus")
    land_articles(views.feed(spark, folder), where)
    days = TimeRange("2024-01-05", "2024-01-09T12:00:00Z")
    return windows.assign_windows(read_corpus(spark, where), days, 24).groupBy("index").agg(F.count("*").alias("articles"))


def _flat(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_articles(
        art.normalize_articles(views.read_corpus_as_pages(spark, folder), KEYWORDS, PHRASES, ENTITIES, ("ENV",))
    )


TURN = {
    "type": "object", "additionalProperties": False, "required": ["conv_id", "turn", "role", "text"],
    "properties": {
        "conv_id": {"type": "integer"}, "turn": {"type": "integer"},
        "role": {"type": "string", "enum": ["user", "assistant"]}, "text": {"type": "string"},
    },
}
PROPS = {
    "type": "object", "additionalProperties": False, "required": ["id", "kind", "value", "tags"],
    "properties": {
        "id": {"type": "integer"}, "kind": {"type": "string", "enum": ["click", "view", "signup", "purchase"]},
        "value": {"type": ["number", "null"]}, "tags": {"type": "array", "items": {"type": "string"}},
    },
}


def _violations(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.table(spark, folder, "conversations")
    found = quality.violations(rows, TURN, "conv_id")
    return found.groupBy("record_id", "path", "rule", "detail").agg(F.count("*").alias("n"))


def _json_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON lines with every kind of fault."""
    return views.table(spark, folder, "events").selectExpr(
        "event_id",
        """concat('{', CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 9 = 1 THEN '"id":true,'
                           WHEN event_id % 9 = 2 THEN '"id":1.0,' WHEN event_id % 9 = 3 THEN '"id":12345678901234567890.0,'
                           WHEN event_id % 9 = 4 THEN '"id":1e3,' WHEN event_id % 9 = 5 THEN '"id":12345678901234567890,'
                           WHEN event_id % 9 = 6 THEN concat('"id":', repeat('9', 45), ',') ELSE concat('"id":', event_id, ',') END,
                  '"kind":"', event_type, '",',
                  CASE WHEN event_id % 6 = 0 THEN '"more":1,' ELSE '' END,
                  '"value":', CASE WHEN event_id % 5 = 0 THEN 'null' WHEN event_id % 5 = 1 THEN '"high"'
                                   ELSE CAST(user_id AS STRING) END, ',',
                  '"tags":', CASE WHEN event_id % 4 = 0 THEN '["a",7]' WHEN event_id % 4 = 1 THEN '{}'
                                  ELSE '["a","b"]' END, '}') AS line""",
    )


def _json_violations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.violations(_json_rows(spark, folder), PROPS, "event_id", json="line")


def _quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_summary(views.table(spark, folder, "conversations"), TURN, "turn")


def _article_quality(spark: SparkSession, folder: str) -> DataFrame:
    done = _matched(spark, folder).drop("window_index", "position")
    return quality.quality_summary(done, CONTRACTS["articles"], "articles")


REQUEST = Request(
    filters=Filters(keywords=("eaux", "and the"), entities=("Nation 7", "nation 1"), exclude_terms=("license",)),
    date_range=JANUARY, max_records=20, sort=Sort.NEWEST, bucket_size="day", batch_window_hours=24,
    scrape_articles=True,
)


# Everything twice, at most two rows a window: every window is halved down to its seconds, of which each is full.
REPEATED = replace(REQUEST, max_records=2)
# An address is never missing: every seventh document has none.
ADDRESSED = {**CONTRACTS["articles"], "properties": {**CONTRACTS["articles"]["properties"], "url": {"type": "string"}}}


def _plain(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    for name, kind in rows.dtypes:
        if kind.startswith("timestamp"):
            rows = rows.withColumn(name, iso_utc(F.col(name)))
        elif kind == "double":
            rows = rows.withColumn(name, F.round(name, 6))
    return rows.select(*columns) if columns else rows


def _steps(spark: SparkSession, name: str) -> str | None:
    """Where a dataset's steps are written: the quality report goes through all tables, so they are cut off from the corpus."""
    return shared_folder(spark) if name == "quality" else None


def _dataset(name: str, *columns: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = build_dataset(
            views.linked_corpus(spark, folder), REQUEST, views.table(spark, folder, "pages"), tie=("doc_id",),
            folder=_steps(spark, name),
        )
        return _plain(tables[name], columns)

    return run


def _repeated(name: str, *columns: str) -> Query:
    """A table of the dataset over a corpus that holds every article twice."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        once = views.linked_corpus(spark, folder)
        twice = dedup.union_fetches([once.withColumn("copy", F.lit(copy)) for copy in (0, 1)])
        found = views.table(spark, folder, "pages")
        tables = build_dataset(
            twice, REPEATED, found, tie=("doc_id", "copy"), folder=_steps(spark, name), contracts={"articles": ADDRESSED}
        )
        return _plain(tables[name], columns)

    return run


def _target(spark: SparkSession, name: str) -> str:
    """A new place on shared storage for a table that is written and read back."""
    return f"{shared_folder(spark)}/pressgrid-{uuid4().hex}/{name}"


def _csv(spark: SparkSession, folder: str) -> DataFrame:
    where = _target(spark, "csv")
    write_articles_csv(_feed_articles(spark, folder), where)
    schema = ", ".join(f"{name} string" for name in FLAT_COLUMNS)
    back = spark.read.schema(schema).options(header=True, quote='"', escape='"').csv(where)
    return back.na.fill("")


def _sections(fmt: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        where = _target(spark, fmt)
        write_sections({"trend_series": series.volume_series(views.feed(spark, folder), "day")}, where, fmt)
        return _text_series(spark.read.schema(SERIES).format(fmt).load(f"{where}/trend_series"))

    return run


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    where = _target(spark, "corpus")
    land_articles(views.feed(spark, folder), where)
    found = predicates.select_articles(
        read_corpus(spark, where), Filters(source_languages=("german",)), TimeRange("2024-01-05", "2024-01-09T12:00:00Z")
    )
    return found.select("event_id", "url", F.date_format("seen_date", "yyyy-MM-dd").alias("seen_date"))


QUERIES: dict[str, Query] = {
    "volume_minute": _volume("minute"),
    "volume_hour": _volume("hour"),
    "volume_day": _volume("day"),
    "normalize_articles": _normalize,
    "match_terms": _match_terms,
    "match_term_table": _match_term_table,
    "entity_tracking_day": _entity_tracking("day"),
    "entity_tracking_hour": _entity_tracking("hour"),
    "rank_language": _rank("languages"),
    "rank_country": _rank("source_countries"),
    "rank_domain": _rank("domains"),
    "rank_entity": _rank("matched_entities"),
    "rank_country_newest": _rank_newest,
    "summary": _summary,
    **{name: _filter(spec) for name, spec in FILTERS.items()},
    "filter_range": _in_range,
    "filter_timespan": _in_span,
    "compact_times": _compact_times,
    "union_fetches": _union,
    "dedup": _dedup,
    "dedup_count": _dedup_counts,
    "sort_date_desc": _sort(Sort.NEWEST),
    "sort_date_asc": _sort(Sort.OLDEST),
    "sort_tone_desc": _sort(Sort.TONE_HIGH),
    "sort_tone_asc": _sort(Sort.TONE_LOW),
    "sort_relevance": _sort(Sort.RELEVANCE),
    "timeline_normalize": _timeline,
    "rebucket_sum": _rebucket("day", "sum"),
    "rebucket_sum_hour": _rebucket("hour", "sum"),
    "rebucket_weighted": _rebucket("day", "weighted_average"),
    "volume_timeline": _volume_timeline,
    "tone_timeline": _tone_timeline,
    "trend_supplied": _trend_supplied,
    "trend_fallback": _trend_fallback,
    "sentiment_series": _sentiment,
    "trend_source": _series_source,
    "analysis_targets": _targets,
    "fixed_windows": _fixed_windows,
    "adaptive_windows": _adaptive_windows,
    "collect_articles": _collect(MAX_ROWS),
    "collect_articles_tight": _collect(1),
    "collect_articles_uncapped": _uncapped,
    "capped_articles": _capped(75, 24),
    "capped_articles_large": _capped(5000, None),
    "coverage_summary": _coverage,
    "coverage_warnings": _warnings,
    "extract_pages": _extract,
    "extract_pages_empty": _extract_empty,
    "enrich_articles": _enrich(None),
    "enrich_limit": _enrich(150),
    "enrich_half": _enrich_half,
    "enrich_crowded": _enrich_crowded,
    "enrich_summary": _enrich_summary,
    "enrich_errors": _enrich_errors,
    "enrich_copies": _enrich_copies,
    "flat_articles": _flat,
    "write_articles_csv": _csv,
    "write_sections_json": _sections("json"),
    "write_sections_parquet": _sections("parquet"),
    "landed_corpus": _landed,
    "landed_windows": _landed_windows,
    "read_articles": _read_articles,
    "read_timeline": _read_timeline,
    "quality_violations": _violations,
    "quality_json_violations": _json_violations,
    "quality_summary": _quality_summary,
    "quality_articles": _article_quality,
    "dataset_articles": _dataset(
        "articles", "article_id", "url", "scrape_status", "scraped_language", "window_index", "position"
    ),
    "dataset_trend": _dataset("trend_series", "bucket_start", "value", "metric", "norm", "label", "source"),
    "dataset_entities": _dataset("entity_tracking"),
    "dataset_summary": _dataset("summary"),
    "dataset_coverage": _dataset("coverage"),
    "dataset_domains": _dataset("domains", "value", "count"),
    "dataset_quality": _dataset("quality", "contract", "records_bad", "validated"),
    "dataset_sentiment": _dataset("sentiment_series"),
    "dataset_enrichment": _dataset("enrichment"),
    "dataset_matched_entities": _dataset("matched_entities", "value", "count"),
    "dataset_windows": _repeated("windows"),
    "dataset_warnings": _repeated("warnings", "split_depth", "message"),
    "dataset_summary_repeated": _repeated("summary"),
    "dataset_coverage_repeated": _repeated("coverage"),
    "dataset_quality_repeated": _repeated("quality", "contract", "records_bad", "validated"),
}
