"""From a landed corpus and a request to the complete set of result tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache, partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgrid.functions.times import seen_timestamp, use_utc
from pressgrid.operators.articles import normalize_articles
from pressgrid.operators.dedup import dedup_articles, fetch_order
from pressgrid.operators.pages import enrich_articles, enrichment_errors, enrichment_summary
from pressgrid.operators.predicates import CORPUS_TEXT, LISTED_TEXT, article_predicate, select_articles, within
from pressgrid.operators.quality import quality_summary
from pressgrid.operators.series import (
    COMPUTED,
    FALLBACK,
    NO_SOURCE,
    SUPPLIED,
    TONE_METRIC,
    VOLUME_METRIC,
    entity_tracking,
    from_timeline,
    normalize_timeline,
    sentiment_series,
    series_source,
    tone_timeline,
    trend_series,
    volume_timeline,
)
from pressgrid.operators.summary import RANKINGS, analysis_targets, dataset_summary, ranking
from pressgrid.operators.windows import (
    adaptive_windows,
    collect_articles,
    coverage_summary,
    coverage_warnings,
    window_tree,
)
from pressgrid.plans.contracts import CONTRACTS
from pressgrid.plans.request import Request, Sort
from pressgrid.sources.staging import Stages


def _dated(corpus: DataFrame) -> DataFrame:
    if "seen_at" in corpus.columns:
        return corpus
    return corpus.withColumn("seen_at", seen_timestamp(F.col("seendate")))


class Dataset(Mapping):
    """All result tables by name. A table is planned when it is first asked for, and runs when it is used.

    Steps that several tables start from belong to ``stages``; ``close`` gives them up, after which tables that were
    named before compute them again, or are gone where they lay in a folder.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame | None]], stages: Stages) -> None:
        self._builders, self._tables, self.stages = builders, {}, stages

    def __getitem__(self, name: str) -> DataFrame | None:
        if name not in self._tables:
            self._tables[name] = self._builders[name]()
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def close(self) -> None:
        self.stages.close()

    def __enter__(self) -> Dataset:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def build_dataset(
    corpus: DataFrame,
    request: Request,
    pages: DataFrame | None = None,
    timeline: DataFrame | None = None,
    tone: DataFrame | None = None,
    tie: tuple[str, ...] = ("url", "title"),
    staged: bool = True,
    folder: str | None = None,
    contracts: Mapping[str, dict] | None = None,
) -> Dataset:
    """All result tables of a request.

    ``corpus`` holds landed articles (``schemas.LISTED_ARTICLE``, optionally with ``seen_at`` and the full
    ``text``); ``tie`` orders articles seen at the same moment. Timelines that are not supplied are computed
    from the corpus, if the request includes them. ``contracts`` replaces record contracts of the quality report by name.

    The selected, collected and finished articles are shared by all tables, and the dataset owns them until it is closed: naming a table starts no job, the first action computes each shared step once and keeps it on the executors' disks.
    With a ``folder`` that all executors reach they are written there as Parquet when first named, so that lost executors cost no
    more than their own tasks. The quality report goes through all tables: without a folder it is one plan that holds the plans of all
    of them, which takes gigabytes of the driver; with one, each table is checked as the report is named. With ``staged=False`` nothing is kept, at the price of one plan from the corpus per table.
    """
    if request.scrape_articles and pages is None:
        raise ValueError("enrichment needs a table of landed pages")
    spark = use_utc(corpus.sparkSession)
    spec, size, hours = request.filters, request.bucket_size, request.batch_window_hours
    span, cap, sort = request.date_range, request.max_records, request.sort
    corpus = _dated(corpus)
    texts = CORPUS_TEXT if "text" in corpus.columns else LISTED_TEXT
    stages, rules = Stages(folder), {**CONTRACTS, **(contracts or {})}

    def kept(rows: DataFrame, name: str) -> DataFrame:
        return stages.keep(rows, name) if staged else rows

    # The full text serves the filters only; it takes no part in any shuffle.
    selected = cache(lambda: kept(select_articles(corpus, spec, span, texts).drop("text", "seen_date"), "selected"))
    raw = cache(lambda: kept(collect_articles(selected(), span, hours, cap, sort, tie=tie, stages=stages), "raw"))
    unique = cache(lambda: dedup_articles(raw()) if request.deduplicate else raw())
    enriched = cache(
        lambda: enrich_articles(unique(), pages, request.scrape_limit, sort, stages=stages)
        if request.scrape_articles else unique()
    )
    articles = cache(lambda: kept(
        normalize_articles(enriched(), spec.keywords, spec.exact_phrases, spec.entities, spec.themes), "articles"
    ))
    tree = cache(lambda: window_tree(selected(), span, hours, cap))

    @cache
    def volume() -> DataFrame | None:
        if timeline is not None:
            return normalize_timeline(timeline, VOLUME_METRIC)
        if request.include_timeline:
            return volume_timeline(within(corpus, span), article_predicate(spec, texts), size)
        return None

    def trend() -> DataFrame:
        if timeline is None and request.include_timeline:
            # Computed from the corpus: where this has no rows there are no articles to fall back on either.
            return from_timeline(volume(), size, "sum", COMPUTED)
        return trend_series(articles(), volume(), size)

    def trend_source() -> DataFrame:
        if volume() is None:
            return spark.range(1).select(F.lit(FALLBACK).alias("trend_source"))
        return series_source(volume(), SUPPLIED if timeline is not None else COMPUTED, FALLBACK, "trend_source")

    tone_source = SUPPLIED if tone is not None else COMPUTED

    @cache
    def sentiment() -> DataFrame | None:
        if tone is not None:
            return sentiment_series(normalize_timeline(tone, TONE_METRIC), size)
        if request.include_tone_timeline:
            return sentiment_series(tone_timeline(selected(), size), size, COMPUTED)
        return None

    def sentiment_source() -> DataFrame:
        if sentiment() is None:
            return spark.range(1).select(F.lit(NO_SOURCE).alias("sentiment_source"))
        return series_source(sentiment(), tone_source, NO_SOURCE, "sentiment_source")

    builders: dict[str, Callable[[], DataFrame | None]] = {
        "articles": lambda: _in_order(articles(), sort),
        "trend_series": lambda: trend().orderBy("bucket_start"),
        "entity_tracking": lambda: entity_tracking(articles(), size).orderBy("bucket_start", "entity"),
        **{name: partial(ranking, articles, name, sort) for name in RANKINGS},
        "summary": lambda: dataset_summary(articles(), raw()),
        "analysis_targets": lambda: analysis_targets(spark, spec.entities, size),
        "windows": lambda: adaptive_windows(selected(), span, hours, cap),
        "coverage": lambda: coverage_summary(tree(), unique(), cap, hours, request.deduplicate),
        "warnings": lambda: coverage_warnings(tree(), cap),
        "trend_source": trend_source,
        "sentiment_source": sentiment_source,
    }
    if tone is not None or request.include_tone_timeline:
        builders["sentiment_series"] = lambda: sentiment().orderBy("bucket_start")
    if request.scrape_articles:
        builders["enrichment"] = lambda: enrichment_summary(articles(), request.scrape_limit)
        builders["enrichment_errors"] = lambda: enrichment_errors(articles())
    if request.validate_schema:
        checked = [name for name in builders if name in CONTRACTS]

        def report(name: str) -> DataFrame:
            found = _checked(name, articles() if name == "articles" else builders[name](), rules[name])
            # In a folder each table is checked by a job of its own; the driver never holds the plans of all tables at once.
            return kept(found, f"checked_{name}") if folder else found

        builders["quality"] = lambda: reduce(DataFrame.unionAll, map(report, checked))
    return Dataset(builders, stages)


def _in_order(articles: DataFrame, sort: Sort) -> DataFrame:
    """Finished articles in sort order. Positions follow the tone already, where tone was asked for."""
    seen = F.col("seen_at")
    first = {Sort.NEWEST: [seen.desc_nulls_last()], Sort.OLDEST: [seen.asc_nulls_first()]}.get(sort, [])
    return articles.orderBy(*first, *fetch_order())


def _checked(name: str, rows: DataFrame, contract: dict) -> DataFrame:
    if name == "articles":
        # Fetch-order columns of the table are allowed beside those of the contract.
        order = {c: {"type": "integer"} for c in ("window_index", "position") if c in rows.columns}
        contract = {**contract, "properties": {**contract["properties"], **order}}
    return quality_summary(rows, contract, name)


__all__ = ["Dataset", "build_dataset"]
