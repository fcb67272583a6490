"""The operators of this folder as queries over the given tables, each over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgrid.llm import (
    ann,
    manifest,
    merkle,
    mixing,
    nra,
    packing,
    pattern_packing,
    quality,
    simhash,
    substring,
    toxicity,
    url_filter,
    warc,
)
from pressgrid.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]

RULES = tuple(url_filter.Rule.of(verdict, text) for verdict, text in (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
    ("block", "net/fr/"),
))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _url_filter(spark: SparkSession, folder: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, RULES, model).select("page_id", "host", "path", "rule", "verdict", "block_score")


def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"), width=4, reach=4)


def _merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.edit_fingerprints(_table(spark, folder, "documents")).drop("edits")


def _ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest_neighbours(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return quality.resample(docs, quality.train(docs, _table(spark, folder, "labels")))


def _packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), tokenizer_path(), keep_ids=False)


def _substring(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs, window=20).select("doc_id", "n_words", "n_removed", "kept_sha256")


def _warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read_archives(*warc.write_archives(_table(spark, folder, "pages"), threshold=0), keep_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def _mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "source", "lang", "topic", "tokens", F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"), "sampled",
    )


def _pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pattern_packing.pack_by_patterns(docs, tokenizer_path("byte_bpe_50k.json"), keep_ids=False)


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.tampered_audit(_table(spark, folder, "documents"))


def _search(spark: SparkSession, folder: str) -> DataFrame:
    return nra.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": _url_filter,
    "op2_simhash": _simhash,
    "op3_fingerprints": _merkle,
    "op4_nearest_neighbours": _ann,
    "op5_quality": _quality,
    "op6_packing": _packing,
    "op7_substring_dedup": _substring,
    "op8_warc": _warc,
    "op9_toxicity": _toxicity,
    "op10_mixing": _mixing,
    "op11_pattern_packing": _pattern_packing,
    "op12_manifest": _manifest,
    "op13_search": _search,
}
