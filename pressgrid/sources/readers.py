"""Sources: landed article listings, timelines and pages. Schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressgrid.functions.times import seen_timestamp, use_utc
from pressgrid.operators.places import numbered
from pressgrid.schemas import LISTED_ARTICLE, LISTED_POINT, RAW_ARTICLE
from pressgrid.sources.staging import STAGES, Stages


def read_articles(spark: SparkSession, path: str, fmt: str = "json", stages: Stages = STAGES) -> DataFrame:
    """Listed articles in fetch order.

    JSON sources hold one response per file with its rows under ``articles``; files are taken in the order
    of their names, which are numbered by ranges. A response without articles contributes no rows. Columnar sources carry
    ``window_index`` and ``position`` themselves.
    """
    use_utc(spark)
    if fmt != "json":
        return spark.read.schema(RAW_ARTICLE).format(fmt).load(path)
    response = T.StructType([T.StructField("articles", T.ArrayType(LISTED_ARTICLE))])
    # multiLine: a response may be one indented document. Files are the unit of parallelism here.
    files = spark.read.schema(response).json(path, multiLine=True).select(
        F.col("_metadata.file_path").alias("file"), "articles"
    )
    # Numbering looks at the names alone, one per file; the contents are not opened for it.
    names = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    places = numbered(names, [F.asc("file")], stages.keep).select("file", F.col("place").cast("int").alias("window_index"))
    rows = files.select("file", F.posexplode("articles").alias("position", "article"))
    return rows.join(places, "file").select("article.*", "window_index", "position")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Landed articles as written by ``land_articles``: Parquet partitioned by ``seen_date``."""
    use_utc(spark)
    return spark.read.parquet(path)


def with_seen_at(articles: DataFrame, strict: bool = True) -> DataFrame:
    """Articles with their ``seendate`` text parsed into ``seen_at``."""
    return articles.withColumn("seen_at", seen_timestamp(F.col("seendate"), strict))


def _first_list(keys: Column, fields: Column) -> Column:
    """The first field, in the order of ``keys``, that is a list of nothing but objects, an empty one included."""

    def points(key: Column) -> Column:
        return F.try_variant_get(F.try_element_at(fields, key), "$", "array<variant>")

    def fits(key: Column) -> Column:
        is_list = F.schema_of_variant(F.try_element_at(fields, key)).startswith("ARRAY")
        return F.coalesce(is_list & F.forall(points(key), lambda p: F.schema_of_variant(p).startswith("OBJECT")), F.lit(False))

    return F.get(F.transform(F.filter(keys, fits), points), F.lit(0))


def read_timeline(spark: SparkSession, path: str, keys: Sequence[str] | None = None) -> DataFrame:
    """The points of each payload file, fields as text.

    A payload's points are its first list of objects, in the order in which its fields are written; with ``keys``, the first one
    under these, in their order. A payload that is no object, names a field twice or has no such list contributes no
    rows. Booleans count as the numbers one and zero where a value is expected.
    """
    use_utc(spark)
    payload = spark.read.text(path, wholetext=True).select(
        F.try_parse_json("value").alias("payload"),
        (F.json_object_keys("value") if keys is None else F.array(*map(F.lit, keys))).alias("keys"),
    )
    fields = F.try_variant_get("payload", "$", "map<string,variant>")
    points = payload.select(F.explode(_first_list(F.col("keys"), fields)).alias("point"))

    def text(name: str):
        value = F.try_variant_get("point", f"$.{name}", "variant")
        plain = F.try_variant_get("point", f"$.{name}", "string")
        kind = F.schema_of_variant(value)
        as_number = F.when(kind == "BOOLEAN", F.when(plain == "true", F.lit("1")).otherwise(F.lit("0")))
        return F.coalesce(as_number, plain).alias(name)

    return points.select(*map(text, LISTED_POINT.fieldNames()))


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed pages: tables with ``url`` and ``html``, or a folder of HTML files read as bytes.

    Files are found by their path as ``url``; join them to addresses with a mapping of your own.
    """
    if fmt == "files":
        return spark.read.format("binaryFile").load(path).select(
            F.col("path").alias("url"), F.col("content").alias("html")
        ).withColumn("page_id", F.xxhash64("url"))
    return spark.read.format(fmt).load(path)
