"""Record contracts: what one row of each result table must look like.

A contract is a nested dict in the usual JSON-Schema words ``type``, ``enum``, ``required``,
``properties``, ``additionalProperties`` and ``items``. The ones here are derived from the declared schemas.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import types as T

from pressgrid import schemas
from pressgrid.operators.series import TONE_METRIC, VOLUME_METRIC

_JSON_TYPES = {
    T.StringType: "string", T.TimestampType: "string", T.DateType: "string", T.LongType: "integer",
    T.IntegerType: "integer", T.DoubleType: "number", T.BooleanType: "boolean", T.StructType: "object",
}


def record_contract(schema: T.StructType, never_null: Iterable[str], **overrides: dict[str, Any]) -> dict:
    """A closed contract with every column required; columns outside ``never_null`` may be null."""
    solid = set(never_null)
    properties: dict[str, Any] = {}
    for column in schema:
        if isinstance(column.dataType, T.ArrayType):
            rule: dict[str, Any] = {
                "type": "array", "items": {"type": _JSON_TYPES[type(column.dataType.elementType)]}
            }
        else:
            rule = {"type": _JSON_TYPES[type(column.dataType)]}
        if column.name not in solid:
            rule["type"] = [rule["type"], "null"]
        properties[column.name] = {**rule, **overrides.get(column.name, {})}
    return {
        "type": "object", "additionalProperties": False, "required": list(properties), "properties": properties,
    }


# Columns that are never null in each table.
ARTICLE = record_contract(
    schemas.ARTICLE,
    ("matched_keywords", "matched_entities", "requested_themes", "scrape_status", "scrape_success",
     "scraped_text_length", "raw"),
    raw={"type": "object"},
)
_KEPT = ("bucket_start", "value", "metric", "source")
TREND = record_contract(schemas.SOURCED_SERIES, _KEPT, metric={"enum": [VOLUME_METRIC]})
SENTIMENT = record_contract(schemas.SOURCED_SERIES, _KEPT, metric={"enum": [TONE_METRIC]})


def _table(**kinds: str | list[str]) -> dict[str, Any]:
    properties = {name: {"type": kind} for name, kind in kinds.items()}
    return {
        "type": "object", "additionalProperties": False, "required": list(properties), "properties": properties,
    }


ENTITY_TRACKING = _table(bucket_start="string", entity="string", article_count="integer")
RANKED = _table(value="string", count="integer", first_at="array")
WINDOW = _table(
    index="integer", start=["string", "null"], end=["string", "null"], timespan=["string", "null"],
    returned_articles="integer", truncated="boolean", split_depth="integer", adaptive_split="boolean",
)
SUMMARY = _table(
    article_count="integer", raw_article_count="integer", duplicates_removed="integer",
    scraped_article_count="integer", scrape_failed_count="integer",
)
COVERAGE = _table(
    batching_enabled="boolean", batch_window_hours=["integer", "null"], batch_count="integer",
    fetch_attempt_count="integer", split_window_count="integer", raw_article_count="integer",
    deduplicated_article_count="integer", duplicates_removed="integer", truncated_window_count="integer",
)
ENRICHMENT = _table(
    requested="boolean", attempted="integer", succeeded="integer", failed="integer", skipped="integer",
    limit=["integer", "null"],
)
CONTRACTS = {
    "articles": ARTICLE, "trend_series": TREND, "sentiment_series": SENTIMENT,
    "entity_tracking": ENTITY_TRACKING, "languages": RANKED, "source_countries": RANKED, "domains": RANKED,
    "matched_entities": RANKED, "windows": WINDOW, "summary": SUMMARY, "coverage": COVERAGE,
    "enrichment": ENRICHMENT,
}
