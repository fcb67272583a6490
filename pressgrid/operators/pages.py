"""Page reading and article enrichment.

Reading HTML is the one step that needs Python. It runs in Arrow batches on the executors and only takes a
page apart; which piece becomes which field is decided by Spark expressions afterwards.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pressgrid.functions.text import blank_to_null, compact_whitespace, strip
from pressgrid.operators.dedup import fetch_key, sort_columns
from pressgrid.operators.places import numbered
from pressgrid.plans.request import Sort
from pressgrid.sources.staging import STAGES, Stages

# Executors get the reading function itself, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EXCERPT_LENGTH = 280
NO_CONTENT = "page has no content"
#: HTML that a Python worker takes apart at once.
SLICE_BYTES = 1 << 20
#: Articles of one address that are enriched together.
CROWD = 100_000
# Where a field is looked up in a page's metadata, first non-empty entry first.
DESCRIPTION_KEYS = ("og:description", "description", "twitter:description")
PUBLISHED_KEYS = ("article:published_time", "parsely-pub-date", "pubdate", "date", "og:pubdate")
TITLE_KEYS = ("og:title", "twitter:title")

_PIECES = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("canonical_url", T.StringType()),
    T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
    T.StructField("paragraphs", T.ArrayType(T.StringType())),
    T.StructField("body", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
])


class _Events(HTMLParser):
    """Writes down tags and text in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.log: list[tuple[str, str, dict[str, str]]] = []

    def handle_starttag(self, tag, attrs):
        self.log.append(("open", tag, {name: value for name, value in attrs if value is not None}))

    def handle_endtag(self, tag):
        self.log.append(("close", tag, {}))

    def handle_data(self, data):
        self.log.append(("text", data, {}))


def page_pieces(html: str) -> dict:
    """The parts of one page: title, language, canonical address, metadata, paragraphs, body text.

    Text inside script, style and noscript does not count. An opening ``p`` starts a new paragraph and
    gives up one that was not closed; paragraphs and body text are free of surplus white space.
    """
    reader = _Events()
    reader.feed(html)
    reader.close()
    found = {"title": "", "language": None, "canonical_url": None, "meta": {}, "paragraphs": [], "body": []}
    muted, in_title, in_body, paragraph = 0, False, False, None
    for kind, what, attrs in reader.log:
        match kind, what:
            case "text", _ if not muted:
                found["title"] += what if in_title else ""
                if paragraph is not None:
                    paragraph += what
                if in_body and what.strip():
                    found["body"].append(" ".join(what.split()))
            case "open", "script" | "style" | "noscript":
                muted += 1
            case "close", "script" | "style" | "noscript":
                muted = max(muted - 1, 0)
            case "open" | "close", "title":
                in_title = kind == "open"
            case "open" | "close", "body":
                in_body = kind == "open"
            case "open", "p":
                paragraph = ""
            case "close", "p" if paragraph is not None:
                if paragraph.strip():
                    found["paragraphs"].append(" ".join(paragraph.split()))
                paragraph = None
            case "open", "br" if paragraph is not None:
                paragraph += " "
            case "open", "html" if attrs.get("lang"):
                found["language"] = attrs["lang"].strip()
            case "open", "link" if "canonical" in attrs.get("rel", "").lower() and attrs.get("href"):
                found["canonical_url"] = attrs["href"].strip()
            case "open", "meta" if attrs.get("content"):
                key = next(filter(None, map(attrs.get, ("property", "name", "http-equiv"))), None)
                if key:
                    found["meta"][key.strip().lower()] = attrs["content"].strip()
    return found


def _read_page(html: str | bytes | None, charset: str | None) -> dict:
    if html is None:
        return {"error": NO_CONTENT}
    try:
        return page_pieces(html if isinstance(html, str) else html.decode(charset or "utf-8", "replace"))
    except Exception as problem:  # one unreadable page becomes an error row
        return {"error": str(problem) or type(problem).__name__}


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows with about ``SLICE_BYTES`` of HTML each; a longer page is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column("_html")), 0).to_pylist()
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > SLICE_BYTES:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages are taken apart and given back slice by slice, so that Python holds the pieces of a slice and not of a batch."""
    pieces = to_arrow_schema(_PIECES)
    for batch in batches:
        kept = [name for name in batch.schema.names if name not in ("_html", "_charset")]
        for part in _slices(batch):
            pages = (_read_page(html.as_py(), charset.as_py()) for html, charset in zip(part["_html"], part["_charset"], strict=True))
            read = [{**page, "meta": [*page["meta"].items()]} if "meta" in page else page for page in pages]
            columns = [pa.array([page.get(field.name) for page in read], field.type) for field in pieces]
            yield pa.RecordBatch.from_arrays(
                [*(part[name] for name in kept), *columns], names=[*kept, *(f"_{name}" for name in pieces.names)]
            )


def _first_meta(keys: tuple[str, ...]) -> Column:
    return F.coalesce(*(blank_to_null(F.try_element_at("_meta", F.lit(key))) for key in keys))


def excerpt(text: Column) -> Column:
    """The first 280 code points, stripped, with dots when the text goes on."""
    head = strip(F.substring(text, 1, EXCERPT_LENGTH))
    return F.when(F.length(text) > EXCERPT_LENGTH, F.concat(head, F.lit("..."))).otherwise(head)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Article fields of each page, next to all columns of ``pages`` other than the HTML.

    ``html`` may be text, or bytes with their encoding in an optional ``charset`` column (UTF-8 if absent;
    undecodable bytes are replaced). A page that cannot be read, or has null HTML, gets status ``error``.
    """
    kept = [c for c in pages.columns if c not in (html, "charset")]
    charset = F.col("charset") if "charset" in pages.columns else F.lit(None).cast("string")
    readable = pages.select(*kept, F.col(html).alias("_html"), charset.alias("_charset"))
    schema = T.StructType(
        [pages.schema[c] for c in kept]
        + [T.StructField(f"_{field.name}", field.dataType) for field in _PIECES]
    )
    read = readable.mapInArrow(_read_batches, schema)
    title = blank_to_null(compact_whitespace(F.col("_title")))
    body = compact_whitespace(F.array_join("_body", " "))
    text = F.coalesce(blank_to_null(F.array_join("_paragraphs", "\n\n")), blank_to_null(body))
    failed = F.col("_error").isNotNull()
    fields = read.select(
        *kept,
        F.when(failed, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        (~failed).alias("success"),
        F.col("_error").alias("error"),
        F.coalesce(title, _first_meta(TITLE_KEYS)).alias("title"),
        _first_meta(DESCRIPTION_KEYS).alias("description"),
        _first_meta(PUBLISHED_KEYS).alias("published_at"),
        blank_to_null(F.col("_language")).alias("language"),
        F.col("_canonical_url").alias("canonical_url"),
        text.alias("text"),
    )
    return fields.withColumns({
        "excerpt": excerpt(F.col("text")),
        "text_length": F.coalesce(F.length("text"), F.lit(0)).cast("long"),
    })


def landed_pages(pages: DataFrame, addresses: DataFrame, order: str = "page_id", html: str = "html") -> DataFrame:
    """One landed page for each of the addresses: the first in ``order`` of those with HTML, or of all if none has any.

    Nulls of ``order`` come last; copies that share it are told apart by their HTML. Which page to take comes from
    addresses, ``order`` and the presence of HTML, counted up before any shuffle. The HTML then moves once, spread by
    address and ``order``, so that copies of one address do not meet in one task.
    """
    named = pages.withColumn("url", strip(F.col("url")))
    filled = F.col(html).isNotNull()
    first = (
        named.groupBy("url")
        .agg(F.max(filled).alias("_filled"), F.min(F.when(filled, F.col(order))).alias("_read"), F.min(order).alias("_any"))
        .join(addresses.distinct(), "url", "left_semi")
        .select(F.col("url").alias("_url"), "_filled", F.when(F.col("_filled"), F.col("_read")).otherwise(F.col("_any")).alias("_order"))
    )
    chosen = (F.col("url") == F.col("_url")) & F.col(order).eqNullSafe(F.col("_order")) & (filled == F.col("_filled"))
    once = F.row_number().over(Window.partitionBy("url", order).orderBy(F.col(html).asc_nulls_last()))
    return (
        named.join(first, chosen, "left_semi")
        .withColumn("_copy", once).filter(F.col("_copy") == 1).drop("_copy")
    )


def first_articles(articles: DataFrame, limit: int, sort: Sort | str, stages: Stages = STAGES) -> DataFrame:
    """Fetch keys of the first ``limit`` articles in sort order.

    Sort keys alone are laid out by ranges, and a row's place follows from its place in its range and the sizes of the
    ranges before; so any number of articles is found without gathering them in one task.
    """
    keys = articles.select("seendate", "window_index", "tone", "position")
    placed = numbered(keys, sort_columns(sort), stages.keep)
    return placed.filter(F.col("place") < limit).select(fetch_key().alias("_fetch_key"))


def _dealt(keyed: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """``keyed`` with ``_salt``, and (_key, _salts) of the addresses that more than ``crowd`` articles share.

    Such an address is dealt out in parts of about ``crowd`` articles.
    """
    crowded = (
        keyed.groupBy("_key").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > crowd)
        .select("_key", F.ceil(F.col("_rows") / crowd).cast("int").alias("_salts"))
    )
    salt = F.pmod(F.xxhash64("window_index", "position"), F.coalesce("_salts", F.lit(1)))
    return keyed.join(crowded, "_key", "left").withColumn("_salt", salt.cast("int")).drop("_salts"), crowded


def enrich_articles(
    articles: DataFrame,
    pages: DataFrame,
    limit: int | None = None,
    sort: Sort | str = Sort.RELEVANCE,
    order: str = "page_id",
    crowd: int = CROWD,
    stages: Stages = STAGES,
) -> DataFrame:
    """Articles with the landed page of their address as the column ``scraped``.

    Only the first ``limit`` articles in sort order are enriched, those without an address counting
    towards the limit; the rest keep a null ``scraped``. Pages are narrowed to the wanted addresses before
    any HTML is read; ``final_url``, ``content_type`` and ``fetched_at`` are taken from them where they are columns. Addresses are counted first: one that more than ``crowd`` articles share is dealt out over tasks, and
    its page is repeated once for each part and no more.
    """
    url = F.coalesce(strip(F.col("url")), F.lit(""))
    # Rows without an address get keys that no address equals, spread so that they do not share a task.
    spread = F.concat(F.lit(" "), F.pmod(F.xxhash64("window_index", "position"), F.lit(4096)).cast("string"))
    keyed = articles.drop("scraped").withColumn("_key", F.when(url == "", spread).otherwise(url))
    if limit is None:
        keyed = keyed.withColumn("_wanted", F.lit(True))
    else:
        chosen = first_articles(articles, limit, sort, stages).withColumn("_wanted", F.lit(True))
        keyed = (
            keyed.withColumn("_fetch_key", fetch_key()).join(chosen, "_fetch_key", "left")
            .withColumn("_wanted", F.coalesce("_wanted", F.lit(False))).drop("_fetch_key")
        )
    addresses = keyed.filter("_wanted").filter(~F.col("_key").startswith(" ")).select(F.col("_key").alias("url"))
    known = {
        "final_url": F.col("final_url") if "final_url" in pages.columns else F.col("url"),
        "content_type": F.col("content_type") if "content_type" in pages.columns else F.lit(None).cast("string"),
        "fetched_at": (F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(None)).cast("timestamp"),
    }
    read = extract_pages(landed_pages(pages, addresses, order).withColumns(known))
    looked_up = read.select(
        F.col("url").alias("_key"),
        F.struct(
            "status", "success", "error", F.col("url").alias("requested_url"),
            *(F.when(F.col("success"), F.col(c)).alias(c) for c in known),
            "title", "description", "published_at", "language", "canonical_url", "text", "excerpt",
            "text_length",
        ).alias("_page"),
    )
    page_type = looked_up.schema["_page"].dataType
    dealt, crowded = _dealt(keyed, crowd)
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_salt")
    repeated = looked_up.join(crowded, "_key", "left").select("_key", "_page", parts)
    joined = dealt.join(repeated, ["_key", "_salt"], "left").drop("_salt")

    def failed(status: str, error: str, requested: Column) -> Column:
        values = {
            "status": F.lit(status), "success": F.lit(False), "error": F.lit(error),
            "requested_url": requested, "text_length": F.lit(0),
        }
        return F.struct(*(
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name) for field in page_type
        ))

    missing = F.col("_key").startswith(" ")
    scraped = (
        F.when(~F.col("_wanted"), F.lit(None).cast(page_type))
        .when(missing, failed("skipped", "missing url", F.lit(None)))
        .when(F.col("_page").isNotNull(), F.col("_page"))
        .otherwise(failed("error", "page not found", F.col("_key")))
    )
    return joined.withColumn("scraped", scraped).drop("_key", "_wanted", "_page")


def _outcome(articles: DataFrame) -> tuple[Column, Column]:
    """State and problem of each article's page, before or after normalisation."""
    if "scrape_status" in articles.columns:
        return F.nullif(F.col("scrape_status"), F.lit("not_requested")), F.col("scrape_error")
    return F.col("scraped.status"), F.col("scraped.error")


def enrichment_summary(articles: DataFrame, limit: int | None = None, requested: bool = True) -> DataFrame:
    """One row of totals over enriched articles, normalised or not. Articles past the limit and those
    without an address count as skipped."""
    status = _outcome(articles)[0] if requested else None

    def count(test: Callable[[], Column]) -> Column:
        return F.count_if(test()) if requested else F.lit(0).cast("long")

    return articles.agg(
        F.lit(requested).alias("requested"),
        count(lambda: status.isin("ok", "error")).alias("attempted"),
        count(lambda: status == "ok").alias("succeeded"),
        count(lambda: status == "error").alias("failed"),
        count(lambda: status.isNull() | (status == "skipped")).alias("skipped"),
        F.lit(limit).cast("int").alias("limit"),
    )


def enrichment_errors(articles: DataFrame) -> DataFrame:
    """``address: problem`` of each failed article, with its place in fetch order."""
    status, error = _outcome(articles)
    return articles.filter((status == "error") & error.isNotNull()).select(
        "window_index", "position", F.concat(strip(F.col("url")), F.lit(": "), error).alias("error")
    )
