"""Bag union, deduplication and ordering of listed articles.

Rows of a DataFrame have no order of their own, so fetch order is carried as the pair
(``window_index``, ``position``), which is unique.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgrid.functions.text import strip
from pressgrid.plans.request import Sort


def fetch_order() -> list[Column]:
    return [F.col("window_index"), F.col("position")]


def fetch_key() -> Column:
    """Fetch order as one number, which hash aggregation can minimise."""
    return F.shiftleft(F.col("window_index").cast("long"), 32) + F.col("position").cast("long")


def union_fetches(parts: Iterable[DataFrame]) -> DataFrame:
    """All rows of all fetches, repeats included. Each part brings its own range of ``window_index``."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def article_identity() -> Column:
    """Rows with one identity are the same article: by address, or by title, time and domain without one."""

    def key(name: str) -> Column:
        return F.coalesce(strip(F.col(name)), F.lit(""))

    url = F.lower(key("url"))
    fallback = F.concat_ws("|", F.lower(key("title")), key("seendate"), F.lower(key("domain")))
    return F.when(url != "", F.concat(F.lit("url:"), url)).otherwise(F.concat(F.lit("fallback:"), fallback))


def dedup_articles(articles: DataFrame) -> DataFrame:
    """The first row of each identity in fetch order.

    Ranking with a cap of one lets Spark drop repeats inside every task before the shuffle, so an article
    that makes up a third of all rows still arrives as one row per task.
    """
    order = Window.partitionBy("_identity").orderBy(*fetch_order())
    return (
        articles.withColumn("_identity", article_identity())
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == 1).drop("_identity", "_rank")
    )


def dedup_counts(articles: DataFrame) -> DataFrame:
    """One row: rows before, identities, and rows that deduplication removes."""
    kinds = articles.groupBy(article_identity().alias("identity")).agg(F.count("*").alias("rows"))
    return kinds.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("raw_article_count"),
        F.count("*").alias("deduplicated_article_count"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicates_removed"),
    )


def sort_columns(sort: Sort | str) -> list[Column]:
    """Columns of a complete order. Dates compare as text with null as empty; other orders keep fetch order,
    tone being ordered inside each window only."""
    seen = F.coalesce(F.col("seendate"), F.lit(""))
    match Sort(sort):
        case Sort.NEWEST:
            return [seen.desc(), *fetch_order()]
        case Sort.OLDEST:
            return [seen.asc(), *fetch_order()]
        case Sort.TONE_HIGH:
            return [F.col("window_index"), F.col("tone").desc_nulls_last(), F.col("position")]
        case Sort.TONE_LOW:
            return [F.col("window_index"), F.col("tone").asc_nulls_last(), F.col("position")]
        case _:
            return fetch_order()


def sort_articles(articles: DataFrame, sort: Sort | str) -> DataFrame:
    """A range-partitioned sort; fetch order breaks ties, so crowded dates still spread over tasks."""
    return articles.orderBy(*sort_columns(sort))
