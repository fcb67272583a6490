"""Declared schemas. Sources are never inferred; outputs have exactly these columns."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
BOOLEAN, TIMESTAMP, STRINGS = T.BooleanType(), T.TimestampType(), T.ArrayType(T.StringType())

# Result of reading one page, as it is nested in an article.
SCRAPED = _struct(
    status=STRING, success=BOOLEAN, error=STRING, requested_url=STRING, final_url=STRING,
    content_type=STRING, fetched_at=TIMESTAMP, title=STRING, description=STRING, published_at=STRING, language=STRING,
    canonical_url=STRING, text=STRING, excerpt=STRING, text_length=LONG,
)

# One article as a source lists it.
LISTED_ARTICLE = _struct(
    url=STRING, url_mobile=STRING, title=STRING, seendate=STRING, socialimage=STRING, domain=STRING,
    language=STRING, sourcecountry=STRING, tone=DOUBLE, themes=STRINGS, scraped=SCRAPED,
)

# Listed articles in fetch order: window by window, and by position inside a window.
RAW_ARTICLE = T.StructType([*LISTED_ARTICLE, T.StructField("window_index", INT), T.StructField("position", INT)])

ARTICLE = _struct(
    article_id=STRING, title=STRING, url=STRING, mobile_url=STRING, seen_at=TIMESTAMP, domain=STRING,
    language=STRING, source_country=STRING, social_image_url=STRING, matched_keywords=STRINGS,
    matched_entities=STRINGS, requested_themes=STRINGS, scrape_status=STRING, scrape_success=BOOLEAN,
    scrape_error=STRING, scraped_title=STRING, scraped_description=STRING,
    scraped_published_at=STRING, scraped_language=STRING, scraped_final_url=STRING,
    scraped_excerpt=STRING, scraped_text=STRING, scraped_text_length=LONG, raw=STRING,
)

SERIES = _struct(bucket_start=TIMESTAMP, value=DOUBLE, metric=STRING, norm=DOUBLE, label=STRING)
# A series in the buckets asked for, with the name of where it came from.
SOURCED_SERIES = T.StructType([*SERIES, T.StructField("source", STRING)])

# A timeline as a source lists it: alternative names for the same thing, all as text.
LISTED_POINT = _struct(**{
    name: STRING
    for name in (
        "date", "datetime", "time", "value", "count", "tone", "ratio", "norm", "total", "allarts", "label",
    )
})
