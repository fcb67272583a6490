"""A corpus pipeline: quality, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir), with ``docs`` what the stage before it kept, and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgrid.llm import mixing, packing, quality, simhash, substring
from pressgrid.llm.queries import tokenizer_path
from pressgrid.sources.staging import shared_folder, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL cannot express the n-gram models, fingerprints or tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the labelled good texts keeps.

    Rows are told apart by id and text: repeated rows stay or go together, texts that share an id, or have none, do not.
    Null and empty texts weigh the same in both models and are kept where such weights are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    keyed = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    chosen = quality.resample(keyed, quality.train(docs, labels), id_column="row_key")
    kept = chosen.filter("kept").select(F.col("doc_id").alias("row_key")).distinct()
    return keyed.join(kept, "row_key", "left_semi").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each near-duplicate group; documents without an id are kept.

    Rows that share an id but not their text are told apart by their fingerprints.
    """
    groups = stage(simhash.near_duplicates(docs, width=4, reach=4), "groups")
    later = F.col("doc_id") != F.col("component_id")
    ids = groups.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(later).alias("all"), F.max(later).alias("any")).filter("any")
    left = docs.join(ids.filter("all"), "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])
    some = ids.filter("NOT all").select("doc_id")
    mixed = left.join(some, "doc_id", "left_semi").withColumn("fingerprint", simhash.fingerprint(F.col("text"), 4))
    first = groups.filter(~later).select("doc_id", F.conv("fingerprint", 16, -10).cast("long").alias("fingerprint"))
    return left.join(some, "doc_id", "left_anti").select(*COLUMNS).unionByName(
        mixed.join(first, ["doc_id", "fingerprint"], "left_semi").select(*COLUMNS)
    )


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words or more that occur earlier; other texts stay as they are."""
    cut = substring.remove_repeats(docs.withColumn("whole", F.col("text")), window=20)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("whole"))
    return cut.select("doc_id", text.alias("text"), "lang", "source").withColumn(
        "n_chars", F.length("text").cast("long")
    ).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to tempered shares of source, language and topic.

    A null source or language is a margin's value like others; repeated rows share their draw.
    """
    mixed = mixing.mix(docs.withColumns({"source_": F.col("source"), "lang_": F.col("lang")}))
    return mixed.filter("sampled").select("doc_id", "text", F.col("lang_").alias("lang"), F.col("source_").alias("source"),
                                          "n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids: each row once, repeated or not; a null text is the end id."""
    return packing.pack_documents(docs, tokenizer_path(), remember=150_000, release=True)


STAGES = [
    ("quality", select_quality),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid4().hex}"
    for name, step in STAGES:
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
