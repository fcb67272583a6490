"""Ranked counts and totals."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgrid.operators.dedup import fetch_key
from pressgrid.operators.series import TONE_METRIC, VOLUME_METRIC
from pressgrid.plans.request import Sort



def appearance(sort: Sort | str, seen: str = "seen_at") -> list[Column]:
    """Whole numbers that together grow along the sort order: for date orders the second, then the fetch key."""
    sort = Sort(sort)
    if sort not in (Sort.NEWEST, Sort.OLDEST):
        return [fetch_key()]
    # Undated articles compare as empty text, hence before every date.
    seconds = F.coalesce(F.unix_seconds(F.col(seen).cast("timestamp")), F.lit(-(1 << 40)))
    return [-seconds if sort == Sort.NEWEST else seconds, fetch_key()]


def ranked_counts(rows: DataFrame, value: str, order: Sequence[Column | str] = ("appearance",)) -> DataFrame:
    """Values by falling count, ties by first appearance: ``value``, ``count``, ``first_at``. Null and empty values are left out.

    ``order`` holds whole numbers, the first of most weight. The least of the first is found for all values by hash aggregation; each
    further number is minimised among the rows that hold the least so far, which are joined by value. ``first_at`` lists the
    numbers of a value's first row.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    numbers = [f"_at{n}" for n in range(len(columns))]
    held = rows.select(
        F.col(value).alias("value"), *(c.cast("long").alias(n) for c, n in zip(columns, numbers, strict=True))
    ).filter(F.col("value").isNotNull() & (F.col("value") != ""))
    found = held.groupBy("value").agg(F.count("*").alias("count"), F.min(numbers[0]).alias(numbers[0]))
    for at, number in enumerate(numbers[1:], 1):
        least = found.select("value", *numbers[:at])
        further = held.join(least, ["value", *numbers[:at]]).groupBy("value").agg(F.min(number).alias(number))
        found = found.join(further, "value")
    return found.orderBy(F.col("count").desc(), *numbers).select("value", "count", F.array(*numbers).alias("first_at"))


RANKINGS = {
    "languages": "language",
    "source_countries": "source_country",
    "domains": "domain",
    "matched_entities": "matched_entities",
}


def ranking(
    articles: DataFrame | Callable[[], DataFrame], name: str, sort: Sort | str = Sort.RELEVANCE
) -> DataFrame:
    """Ranked counts of one of ``RANKINGS``."""
    column = RANKINGS[name]
    rows, order = articles() if callable(articles) else articles, appearance(sort)
    if name == "matched_entities":
        # Inside one article, entities appear in the order in which they were asked for.
        names = [f"order{at}" for at in range(len(order))]
        rows = rows.select(
            *(c.alias(n) for c, n in zip(order, names, strict=True)), F.posexplode_outer(column).alias("at", column)
        )
        order = [*names, "at"]
    return ranked_counts(rows, column, order)


def rankings(articles: DataFrame, sort: Sort | str = Sort.RELEVANCE) -> dict[str, DataFrame]:
    """Ranked counts of language, source country, domain and matched entity."""
    return {name: ranking(articles, name, sort) for name in RANKINGS}


def dataset_summary(articles: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """One row of totals. ``scrape_failed_count`` counts every state but ``ok`` and ``not_requested``.

    ``raw`` are the rows before deduplication; without it nothing was removed.
    """
    finished = articles.select(
        F.lit(1).alias("final"), "scrape_success", "scrape_status"
    )
    before = (raw if raw is not None else articles).select(
        F.lit(0).alias("final"), F.lit(None).cast("boolean").alias("scrape_success"),
        F.lit(None).cast("string").alias("scrape_status"),
    )
    final = F.col("final") == 1
    totals = finished.unionByName(before).agg(
        F.count_if(final).alias("article_count"),
        F.count_if(~final).alias("raw_article_count"),
        F.count_if("scrape_success").alias("scraped_article_count"),
        F.count_if(final & ~F.col("scrape_status").isin("ok", "not_requested")).alias("scrape_failed_count"),
    )
    return totals.select(
        "article_count", "raw_article_count",
        (F.col("raw_article_count") - F.col("article_count")).alias("duplicates_removed"),
        "scraped_article_count", "scrape_failed_count",
    )


def analysis_targets(spark: SparkSession, entities: Sequence[str], size: str) -> DataFrame:
    """One row: the metrics of the two series, the entities tracked, and the bucket size."""
    names = [e.strip() for e in entities if e and e.strip()]
    return spark.range(1).select(
        F.lit(VOLUME_METRIC).alias("trend_metric"),
        F.lit(TONE_METRIC).alias("sentiment_metric"),
        F.array(*map(F.lit, names)).cast("array<string>").alias("tracked_entities"),
        F.lit(size).alias("bucket_size"),
    )
