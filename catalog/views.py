"""The given tables seen as news data. Every view covers its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgrid.functions.times import use_utc

FEED_COLUMNS = """
    event_id,
    CASE WHEN event_id % 7 = 0 THEN NULL
         WHEN event_id % 10 = 3 THEN upper(concat('https://', event_type, '.example.com/', user_id, '/',
                                                  CAST(floor(value) AS BIGINT)))
         ELSE concat('https://', event_type, '.example.com/', user_id, '/', CAST(floor(value) AS BIGINT))
    END AS url,
    CAST(NULL AS STRING) AS url_mobile,
    concat(event_type, ' reported by user ', user_id) AS title,
    date_format(CAST(ts AS TIMESTAMP), "yyyyMMdd'T'HHmmss'Z'") AS seendate,
    date_trunc('second', CAST(ts AS TIMESTAMP)) AS seen_at,
    CAST(NULL AS STRING) AS socialimage,
    concat(event_type, '.example.com') AS domain,
    CASE user_id % 4 WHEN 0 THEN 'English' WHEN 1 THEN 'French' WHEN 2 THEN 'German' ELSE 'Spanish' END
        AS language,
    replace(n_name, '_', ' ') AS sourcecountry,
    5 - value / 10 AS tone,
    array(concat('EVT_', upper(event_type))) AS themes,
    CAST(event_id DIV 100 AS INT) AS window_index,
    CAST(event_id % 100 AS INT) AS position
"""

CORPUS_COLUMNS = """
    doc_id,
    CASE WHEN doc_id % 7 = 0 THEN NULL
         ELSE concat('https://', source, '.example.com/a/', doc_id) END AS url,
    CAST(NULL AS STRING) AS url_mobile,
    concat('Report from ', replace(n_name, '_', ' '), ' by ', source) AS title,
    timestamp_seconds(1704067200 + doc_id * 7919 % 2592000) AS seen_at,
    date_format(timestamp_seconds(1704067200 + doc_id * 7919 % 2592000), "yyyyMMdd'T'HHmmss'Z'") AS seendate,
    CAST(NULL AS STRING) AS socialimage,
    concat(source, '.example.com') AS domain,
    lang AS language,
    replace(n_name, '_', ' ') AS sourcecountry,
    CAST(n_chars % 2001 - 1000 AS DOUBLE) / 100 AS tone,
    array(concat('LANG_', upper(lang)), concat('SRC_', upper(source))) AS themes,
    text,
    CAST(doc_id DIV 100 AS INT) AS window_index,
    CAST(doc_id % 100 AS INT) AS position
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _with_nation(rows: DataFrame, spark: SparkSession, folder: str, key: str) -> DataFrame:
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return rows.join(nation, F.expr(f"CAST({key} % 25 AS INT)") == nation["n_nationkey"])


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """Events as article listings: short rows, real times, repeated addresses."""
    rows = _with_nation(table(spark, folder, "events"), spark, folder, "user_id")
    return rows.selectExpr(*_split(FEED_COLUMNS))


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as landed articles with their whole text."""
    rows = _with_nation(table(spark, folder, "documents"), spark, folder, "doc_id")
    return rows.selectExpr(*_split(CORPUS_COLUMNS))


def read_corpus_as_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as articles whose page has been read already: the text sits in ``scraped``."""
    page = F.struct(
        F.lit("ok").alias("status"), F.lit(True).alias("success"), F.col("text"),
        F.length("text").cast("long").alias("text_length"),
    )
    return corpus(spark, folder).withColumn("scraped", page).drop("text")


def linked(spark: SparkSession, folder: str) -> DataFrame:
    """Article listings without text; those of the first documents carry the address of a landed page."""
    return linked_corpus(spark, folder).drop("text")


def linked_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Landed articles with text and, where there is a landed page, its address."""
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("page_url"))
    return corpus(spark, folder).join(pages, "doc_id", "left").withColumn(
        "url", F.coalesce("page_url", "url")
    ).drop("page_url")


def timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Events as supplied timeline points: three date layouts, norms null, zero or positive."""
    return table(spark, folder, "events").selectExpr(
        "event_id",
        """CASE event_id % 4
             WHEN 0 THEN date_format(CAST(ts AS TIMESTAMP), "yyyyMMdd'T'HHmmss'Z'")
             WHEN 1 THEN date_format(CAST(ts AS TIMESTAMP), 'yyyyMMdd')
             WHEN 2 THEN date_format(CAST(ts AS TIMESTAMP), "yyyy-MM-dd'T'HH:mm:ss'Z'")
             ELSE date_format(CAST(ts AS TIMESTAMP), 'yyyyMMddHHmmss') END AS date""",
        "CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END"
        " AS value",
        "CASE WHEN event_id % 11 = 0 THEN '7' END AS count",
        "CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN '0' ELSE CAST(user_id AS STRING) END"
        " AS norm",
    )


def _split(columns: str) -> list[str]:
    """Top-level comma-separated expressions of a select list."""
    parts, depth, quote, current = [], 0, "", ""
    for ch in columns:
        if quote:
            quote = "" if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        elif ch in "()":
            depth += 1 if ch == "(" else -1
        if ch == "," and depth == 0 and not quote:
            parts.append(current.strip())
            current = ""
        else:
            current += ch
    return [*parts, current.strip()]
