"""Time series: supplied timelines, local counts, rebucketing and entity tracking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgrid.functions.numbers import first_number, to_number
from pressgrid.functions.text import blank_to_null
from pressgrid.functions.times import bucket, timeline_timestamp

VOLUME_METRIC = "article_count"
TONE_METRIC = "average_tone"
# Alternative names of the same thing in supplied timelines, first usable one first.
DATE_KEYS = ("date", "datetime", "time")
VALUE_KEYS = ("value", "count", "tone", "ratio")
NORM_KEYS = ("norm", "total", "allarts")
# Where a series came from.
SUPPLIED, COMPUTED, FALLBACK, NO_SOURCE = (
    "supplied-timeline", "corpus-timeline", "article-bucket-fallback", "not_available",
)


def normalize_timeline(points: DataFrame, metric: str) -> DataFrame:
    """Supplied points as series rows; those without a date or a numeric value are dropped.

    A date that fits no layout stays as a row with a null ``bucket_start``: it still shows that the
    timeline was supplied, and rebucketing drops it.
    """

    def text(*names: str) -> list[Column]:
        return [F.col(n).cast("string") for n in names if n in points.columns]

    *preferred, last = text(*DATE_KEYS) or [F.lit(None).cast("string")]
    date = F.coalesce(*map(blank_to_null, preferred), last)
    none = F.lit(None).cast("string")
    return points.select(
        date.alias("_date"),
        first_number(*(text(*VALUE_KEYS) or [none])).alias("value"),
        F.lit(metric).alias("metric"),
        first_number(*(text(*NORM_KEYS) or [none])).alias("norm"),
        (text("label") or [none])[0].alias("label"),
    ).filter(F.col("_date").isNotNull() & F.col("value").isNotNull()).select(
        timeline_timestamp(F.col("_date")).alias("bucket_start"), "value", "metric", "norm", "label"
    )


def rebucket(series: DataFrame, size: str, aggregation: str) -> DataFrame:
    """One row per bucket and metric: ``sum`` of the values, or their ``weighted_average``.

    A weight is the norm where that is positive, otherwise one. Norms add up, a total of zero becoming
    null; labels do not survive.
    """
    value = F.col("value").cast("double")
    norm = to_number(F.col("norm")) if dict(series.dtypes)["norm"] == "string" else F.col("norm").cast("double")
    match aggregation:
        case "sum":
            combined = F.sum("_value")
        case "weighted_average":
            weight = F.when(F.col("_norm") > 0, F.col("_norm")).otherwise(F.lit(1.0))
            combined = F.sum(F.col("_value") * weight) / F.sum(weight)
        case _:
            raise ValueError(f"aggregation must be sum or weighted_average, not {aggregation!r}")
    start = bucket(F.col("bucket_start"), size)
    return (
        series.select(start.alias("bucket_start"), "metric", value.alias("_value"), norm.alias("_norm"))
        .dropna(subset=["bucket_start", "metric", "_value"])
        .groupBy("bucket_start", "metric")
        .agg(combined.alias("value"), F.nullif(F.sum("_norm"), F.lit(0.0)).alias("norm"))
        .select("bucket_start", "value", "metric", "norm", F.lit(None).cast("string").alias("label"))
    )


def _series_row(start: Column, value: Column, metric: str, norm: Column) -> list[Column]:
    return [
        start.alias("bucket_start"), value.cast("double").alias("value"), F.lit(metric).alias("metric"),
        norm.cast("double").alias("norm"), F.lit(None).cast("string").alias("label"),
    ]


def volume_series(articles: DataFrame, size: str, seen: str = "seen_at") -> DataFrame:
    """Articles per bucket; undated ones are left out, and empty buckets have no row."""
    counts = (
        articles.filter(F.col(seen).isNotNull()).groupBy(bucket(F.col(seen), size).alias("start"))
        .agg(F.count("*").alias("n"))
    )
    return counts.select(*_series_row(F.col("start"), F.col("n"), VOLUME_METRIC, F.lit(None)))


def volume_timeline(articles: DataFrame, predicate: Column, size: str, seen: str = "seen_at") -> DataFrame:
    """Matching articles per bucket, with all articles of the bucket as the norm."""
    counts = (
        articles.filter(F.col(seen).isNotNull())
        .select(bucket(F.col(seen), size).alias("start"), predicate.alias("hit"))
        .groupBy("start").agg(F.count_if("hit").alias("hits"), F.count("*").alias("n"))
    )
    return counts.select(*_series_row(F.col("start"), F.col("hits"), VOLUME_METRIC, F.col("n")))


def tone_timeline(articles: DataFrame, size: str, seen: str = "seen_at") -> DataFrame:
    """Average tone per bucket over the articles that have one; their number is the norm."""
    means = (
        articles.filter(F.col(seen).isNotNull() & F.col("tone").isNotNull())
        .groupBy(bucket(F.col(seen), size).alias("start"))
        .agg(F.avg("tone").alias("mean"), F.count("tone").alias("n"))
    )
    return means.select(*_series_row(F.col("start"), F.col("mean"), TONE_METRIC, F.col("n")))


def from_timeline(timeline: DataFrame, size: str, aggregation: str, source: str = SUPPLIED) -> DataFrame:
    """A timeline in the buckets asked for, with the name of where it came from."""
    return rebucket(timeline, size, aggregation).withColumn("source", F.lit(source))


def trend_series(articles: DataFrame, timeline: DataFrame | None, size: str, seen: str = "seen_at") -> DataFrame:
    """The supplied volume timeline, or local counts when it has no rows at all; ``source`` says which.

    The choice is an uncorrelated EXISTS inside the plan, so nothing runs before the result is used. It is
    asked of the articles rather than of their counts, so that with a timeline no article gets past the scan.
    """
    if timeline is None:
        return from_timeline(volume_series(articles, size, seen), size, "sum", FALLBACK)
    local = volume_series(articles.where(~timeline.exists()), size, seen)
    return from_timeline(timeline, size, "sum").unionByName(from_timeline(local, size, "sum", FALLBACK))


def sentiment_series(timeline: DataFrame | None, size: str, source: str = SUPPLIED) -> DataFrame | None:
    """The tone timeline by weighted average. Tone has no local substitute."""
    return None if timeline is None else from_timeline(timeline, size, "weighted_average", source)


def series_source(rows: DataFrame, present: str, absent: str, name: str) -> DataFrame:
    """One row naming where a series came from, by whether ``rows`` has any.

    For a trend these are the timeline's rows before rebucketing, readable or not; for sentiment, the series.
    """
    source = F.when(rows.exists(), F.lit(present)).otherwise(F.lit(absent))
    return rows.sparkSession.range(1).select(source.alias(name))


def entity_tracking(articles: DataFrame, size: str, seen: str = "seen_at") -> DataFrame:
    """Articles per bucket and matched entity; an entity asked for twice counts twice.

    The outer explode keeps Catalyst from testing the list, and so folding the text, a second time.
    """
    return (
        articles.filter(F.col(seen).isNotNull())
        .select(bucket(F.col(seen), size).alias("bucket_start"), F.explode_outer("matched_entities").alias("entity"))
        .filter(F.col("entity").isNotNull())
        .groupBy("bucket_start", "entity").agg(F.count("*").alias("article_count"))
    )
