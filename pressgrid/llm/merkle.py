"""Document fingerprints: Merkle trees over sections and paragraphs, in Spark functions alone."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTION, PARAGRAPH = "\n\n", "\n"
#: White space after one of these letters or marks ends a phrase, the leaf below a paragraph. Cuts depend on the text
#: around them alone, so an edit changes the phrases it touches and no others.
PHRASE_END = r"(?<=[.!?;:,|aeghnouyAEGHNOUY])[ \t\r]+"


def merkle_tree(text: Column) -> Column:
    """Struct of ``root`` (64 hex digits), ``sections`` and ``phrases``; a null text counts as empty.

    A section (text between blank lines) holds the digests of its paragraphs (lines); its own digest covers those, and
    the root covers the section digests. Cutting at the bare separators loses nothing, so equal roots mean equal texts.
    ``phrases`` holds the distinct 64-bit digests of the leaves.
    """
    whole = F.coalesce(text, F.lit(""))
    sections = F.transform(
        F.split(whole, SECTION, -1),
        lambda section: F.transform(F.split(section, PARAGRAPH, -1), lambda line: F.sha2(line, 256)),
    )
    digests = F.transform(
        sections, lambda lines: F.struct(F.sha2(F.array_join(lines, ""), 256).alias("digest"), lines.alias("paragraphs"))
    )
    phrases = F.array_distinct(F.transform(
        F.filter(F.split(whole, rf"{PHRASE_END}|\n+", -1), lambda phrase: phrase != ""), lambda phrase: F.xxhash64(phrase)
    ))
    return F.struct(
        F.sha2(F.array_join(F.transform(digests, lambda s: s["digest"]), ""), 256).alias("root"),
        digests.alias("sections"), phrases.alias("phrases"),
    )


def likeness(left: Column, right: Column) -> Column:
    """Share of leaves that two trees have in common, from 0 to 1; 1 for equal roots."""
    shared = F.size(F.array_intersect(left["phrases"], right["phrases"]))
    every = F.size(left["phrases"]) + F.size(right["phrases"])
    return F.when(left["root"] == right["root"], 1.0).when(every == 0, 0.0).otherwise(2.0 * shared / every)


def differing_branches(left: Column, right: Column) -> Column:
    """Where two trees differ: an array of (section, paragraph) places from 0; none for equal roots.

    Only sections whose digests differ are opened. What one side lacks counts as differing.
    """
    none = F.array().cast("array<string>")

    def paired(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.struct(x.alias("l"), y.alias("r")))

    def lines(pair: Column, section: Column) -> Column:
        both = paired(F.coalesce(pair["l"]["paragraphs"], none), F.coalesce(pair["r"]["paragraphs"], none))
        marked = F.transform(both, lambda line, at: F.when(
            ~line["l"].eqNullSafe(line["r"]), F.struct(section.alias("section"), at.alias("paragraph"))
        ))
        return F.filter(marked, lambda place: place.isNotNull())

    places = F.flatten(F.transform(paired(left["sections"], right["sections"]), lambda pair, section: F.when(
        ~pair["l"]["digest"].eqNullSafe(pair["r"]["digest"]), lines(pair, section)
    ).otherwise(F.array().cast("array<struct<section:int,paragraph:int>>"))))
    return F.when(left["root"] == right["root"], F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(
        places
    )


def _blocks(docs: DataFrame, count: int) -> tuple[DataFrame, list[float]]:
    """Rows with their ``block``: ranges of ids, cut at quantiles; block numbers rise with ids, nulls are lowest."""
    cuts = sorted({*docs.approxQuantile("doc_id", [k / count for k in range(1, count)], 0.2 / count)}) if count > 1 else []
    if not cuts:
        return docs.withColumn("block", F.when(F.col("doc_id").isNull(), 0.0).otherwise(1.0)), cuts
    edges = [-float("inf"), *cuts, float("inf")]
    placed = Bucketizer(splits=edges, inputCol="at", outputCol="block", handleInvalid="keep").transform(
        docs.withColumn("at", F.col("doc_id").cast("double"))
    ).drop("at")
    return placed.withColumn("block", F.when(F.col("doc_id").isNull(), 0.0).otherwise(F.col("block") + 1)), cuts


def with_next_text(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``, that of the next lower id; after the lowest comes the highest.

    Ids are cut into ranges at quantiles, four for each shuffle partition, so that the ordered step runs over many tasks
    and texts move once. The first row of each range is also sent to the range above, whose last row needs it: as many
    rows as there are ranges. Equal ids are ordered by text; null ids come last.
    """
    spark = docs.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, _ = _blocks(docs.select("doc_id", "text"), blocks)
    heads = rows.groupBy("block").agg(F.max("doc_id").alias("head_id"))
    above = heads.select(
        F.coalesce(F.lead("block").over(Window.orderBy("block")), F.min("block").over(Window.partitionBy(F.lit(1))))
        .alias("to"), F.col("block").alias("from"), "head_id",
    )
    guests = rows.alias("d").join(  # as many rows as there are ranges: small enough to broadcast
        F.broadcast(above.alias("h")), (F.col("d.block") == F.col("h.from")) & F.col("d.doc_id").eqNullSafe(F.col("h.head_id"))
    ).select("d.doc_id", "d.text", F.col("h.to").alias("block"), F.lit(1).alias("guest"))
    together = rows.withColumn("guest", F.lit(0)).unionByName(guests)
    order = Window.partitionBy("block").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc_nulls_last("text"))
    return together.withColumn("next_text", F.lead("text").over(order)).filter("guest = 0").drop("block", "guest")


def edit_fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half begins the next document.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document in falling id order; after the last comes the first. Columns: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint`` (Merkle roots), ``near_edited``, ``near_next``, and ``edits``, the places
    (section, paragraph) of the branches that differ. A null text counts as empty; an empty text stays empty and is
    like itself. A single row follows itself. Repeated rows are repeated, ordered by text.
    """
    own = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    paired = with_next_text(own).select(
        "doc_id", "text", "next_text", size.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half)).alias("edited"),
    )
    trees = paired.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), merkle_tree(F.col("text")).alias("own"),
        merkle_tree(F.col("edited")).alias("new"), merkle_tree(F.col("next_text")).alias("next"),
    )
    own_tree, new, following = F.col("own"), F.col("new"), F.col("next")
    return trees.select(
        "doc_id", "n_chars", "edited_sha256", own_tree["root"].alias("fingerprint"),
        new["root"].alias("edited_fingerprint"), likeness(own_tree, new).alias("near_edited"),
        likeness(own_tree, following).alias("near_next"), differing_branches(own_tree, new).alias("edits"),
    )
