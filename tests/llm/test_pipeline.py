"""The queries of the subpackage against SQL, and the pipeline's stages one by one."""

from __future__ import annotations

import pytest
from compare import difference, duck

import corpus_pipeline as pipeline
from pressgrid.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), duck(FOLDER), ORACLES[name]) is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_duplicates", "substring_dedup", "mixing", "packing"]
    for name, step in pipeline.STAGES:
        before, after = docs, step(spark, docs, FOLDER)
        after.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == list(pipeline.COLUMNS)
            assert docs.join(before, "doc_id", "left_anti").count() == 0 < docs.count()
    assert docs.filter("length(ids) <> 4 * length").count() == 0 < docs.count()


def test_stages_odd(spark):
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "x", "en", "a", 1)]
    for frame in (spark.createDataFrame(rows, shape), spark.createDataFrame([], shape)):
        for _, step in pipeline.STAGES:
            step(spark, frame, FOLDER).collect()


def test_texts_of_one_id(spark):
    """Rows are judged by id and text: another text under the same id, or none, goes its own way."""
    junk = "zq zq zq zq zq zq zq zq zq zq " * 20
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = docs.join(spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 1"), "doc_id").select(docs["*"]).orderBy("doc_id").first()
    more = spark.createDataFrame(
        [(n, text, "en", "a", 1) for n in (good.doc_id, None) for text in (good.text, junk)], docs.schema
    )
    found = pipeline.select_quality(spark, docs.unionByName(more), FOLDER)
    kept = [(r.doc_id, r.text) for r in found.collect() if r.source == "a" or r.doc_id is None]
    assert (good.doc_id, good.text) in kept and (None, good.text) in kept
    assert not [x for x in kept if x[1] == junk]
