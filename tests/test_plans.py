"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PYTHON = (
    "extract_pages", "extract_pages_empty", "enrich_articles", "enrich_copies", "enrich_crowded", "enrich_half", "enrich_limit",
    "enrich_summary", "enrich_errors", "summary",
)


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("dataset_")))
def test_no_python_outside_page_reading_and_no_cross_joins(spark, name):
    text = plan(spark, name)
    if name not in PYTHON:
        assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_dedup_and_caps_cut_before_the_shuffle(spark):
    for name in ("dedup", "capped_articles", "collect_articles"):
        text = plan(spark, name)
        assert "row_number(), 1, Partial" in text or "Partial" in text.split("WindowGroupLimit", 1)[1], name


def test_counts_stay_in_hash_aggregation(spark):
    for name in ("rank_domain", "rank_country_newest", "rank_entity", "volume_day", "rebucket_weighted", "adaptive_windows"):
        text = plan(spark, name)
        assert "HashAggregate" in text and "SortAggregate" not in text, name


def test_only_needed_columns_are_read(spark):
    assert "html" not in plan(spark, "volume_day")
    read = plan(spark, "volume_day").split("ReadSchema: ")[1].split("\n")[0]
    assert "props" not in read and "value" not in read
    assert "text" not in plan(spark, "filter_range").split("ReadSchema: ")[1].split("\n")[0]


def test_text_stays_out_of_shuffles(spark):
    for name in ("dedup", "rank_entity", "enrich_limit"):
        assert "text#" not in "".join(line for line in plan(spark, name).split("\n") if "FileScan" in line), name
