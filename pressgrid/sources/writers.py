"""Sinks: section tables, the flat article table, and landed corpora."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgrid.functions.times import iso_utc

# Columns of the flat article table, in order.
FLAT_COLUMNS = (
    "article_id", "title", "url", "mobile_url", "seen_at", "domain", "language", "source_country",
    "social_image_url", "matched_keywords", "matched_entities", "requested_themes", "scrape_status",
    "scraped_title", "scraped_description", "scraped_published_at", "scraped_language",
    "scraped_text_length", "scraped_excerpt",
)
LIST_SEPARATOR = " | "


def flatten_articles(articles: DataFrame) -> DataFrame:
    """Articles as text columns only: lists joined, times in ISO form, null as empty text."""
    kinds = dict(articles.dtypes)

    def flat(name: str):
        column = F.col(name)
        if kinds[name].startswith("array"):
            column = F.array_join(column, LIST_SEPARATOR)
        elif kinds[name].startswith("timestamp"):
            column = iso_utc(column)
        return F.coalesce(column.cast("string"), F.lit("")).alias(name)

    return articles.select(*map(flat, FLAT_COLUMNS))


def write_articles_csv(articles: DataFrame, path: str) -> None:
    """The flat table as CSV with a header; quotes inside a value are doubled."""
    (
        flatten_articles(articles).write.mode("overwrite")
        .options(header=True, quote='"', escape='"', emptyValue="", encoding="UTF-8").csv(path)
    )


def _as_json(rows: DataFrame) -> DataFrame:
    """Times in ISO form, and the kept source record as an object instead of text."""
    columns = {}
    for name, kind in rows.dtypes:
        if kind.startswith("timestamp"):
            columns[name] = iso_utc(F.col(name))
        elif name == "raw" and kind == "string":
            columns[name] = F.parse_json(name)
    return rows.withColumns(columns)


def write_sections(sections: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Each section as a table of its own under ``path``. Text is UTF-8, nothing is escaped to ASCII."""
    for name, rows in sections.items():
        if fmt == "json":
            # Explicit nulls: a contract tells a null field from a missing one.
            _as_json(rows).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}")
        else:
            rows.write.mode("overwrite").format(fmt).save(f"{path}/{name}")


def land_articles(articles: DataFrame, path: str) -> None:
    """Articles with ``seen_at`` as Parquet partitioned by day, for pruning by time range.

    The rebalance hint splits crowded days over several tasks and files, and merges thin ones.
    """
    dated = articles.withColumn("seen_date", F.to_date("seen_at"))
    dated.hint("rebalance", "seen_date").write.mode("overwrite").partitionBy("seen_date").parquet(path)
