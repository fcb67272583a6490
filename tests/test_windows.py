from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pressgrid.functions import iso_utc
from pressgrid.operators.windows import (
    adaptive_windows, assign_windows, cap_per_window, collect_articles, coverage_summary, coverage_warnings,
    fixed_windows, window_tree,
)
from pressgrid.plans.request import Sort, TimeRange

START = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.fixture
def seen(spark):
    def build(*offsets):
        rows = [(i, START + timedelta(seconds=s), f"u{i}", "t", float(i % 7)) for i, s in enumerate(offsets)]
        return spark.createDataFrame(rows, "id int, seen_at timestamp, url string, title string, tone double")

    return build


def model(offsets, total, step, cap):
    """Plain recursion over one list of offsets: leaves, inner windows."""
    leaves, inner = [], []

    def visit(lo, hi, depth):
        rows = [o for o in offsets if lo <= o < hi or (hi == total and o == hi)]
        if len(rows) >= cap and int(hi - lo) >= 2:
            inner.append((lo, hi, depth))
            middle = lo + int(hi - lo) // 2
            visit(lo, middle, depth + 1)
            visit(middle, hi, depth + 1)
        else:
            leaves.append((lo, hi, len(rows), depth))

    at = 0
    while at < total:
        visit(at, min(at + step, total), 0)
        at += step
    return leaves, inner


@pytest.mark.parametrize("seed,total,hours,cap", [
    (1, 7200, 1, 3), (2, 10000, 2, 5), (3, 3601.5, 1, 2), (4, 5400.25, None, 4), (5, 86400, 24, 10), (6, 3, None, 1),
    (7, 400000, None, 4), (8, 2**18, 60, 3),
])
def test_halving_against_recursion(seen, seed, total, hours, cap):
    pick = random.Random(seed)
    hot = pick.uniform(0, total)
    offsets = [round(pick.choice([pick.uniform(0, total), hot, min(total, hot + pick.random())]), 3) for _ in range(150)]
    offsets += [0, total, total]
    offsets = [min(o, total) for o in offsets]
    span = TimeRange(START, START + timedelta(seconds=total))
    rows = seen(*offsets)
    leaves, inner = model(offsets, total, (hours or 10**6) * 3600, cap)
    got = adaptive_windows(rows, span, hours, cap).orderBy("index").collect()

    def second(ts):
        return round((ts.replace(tzinfo=UTC) - START).total_seconds(), 6)

    assert [r["index"] for r in got] == list(range(1, len(leaves) + 1))
    assert [(second(r.start), second(r.end), r.returned_articles, r.truncated, r.split_depth) for r in got] == [
        (lo, hi, min(n, cap), n >= cap, depth) for lo, hi, n, depth in leaves
    ]
    tree = window_tree(rows, span, hours, cap).collect()
    assert sorted((second(r.start), second(r.end), r.depth) for r in tree if not r.leaf) == sorted(inner)

    taken = collect_articles(rows, span, hours, cap, Sort.OLDEST, tie=("id",)).collect()
    expected = []
    for lo, hi, _, _ in leaves:
        inside = sorted((o, i) for i, o in enumerate(offsets) if lo <= o < hi or (hi == total and o == hi))
        expected += [(i, at) for at, (_, i) in enumerate(inside[:cap])]
    ordered = sorted(taken, key=lambda r: (r.window_index, r.position))
    assert [(r.id, r.position) for r in ordered] == expected


def test_golden_four_hours_with_cap_two(seen):
    """One row in each half: three fetches, one split, two leaves, nothing cut off."""
    rows = seen(1800, 9000)
    span = TimeRange(START, START + timedelta(hours=4))
    tree = window_tree(rows, span, 24, 2)
    totals = coverage_summary(tree, rows, 2).first()
    assert (totals.fetch_attempt_count, totals.split_window_count, totals.batch_count) == (3, 1, 2)
    assert (totals.truncated_window_count, totals.raw_article_count, totals.batching_enabled) == (0, 2, True)
    (warning,) = coverage_warnings(tree, 2).collect()
    assert warning.message == (
        "2 articles or more in the window 2024-01-01T00:00:00Z to 2024-01-01T04:00:00Z: it is read in halves"
    )


def test_full_second_is_truncated(seen):
    rows = seen(*[10] * 5)
    span = TimeRange(START + timedelta(seconds=10), START + timedelta(seconds=11))
    (window,) = adaptive_windows(rows, span, 24, 5).collect()
    assert window.truncated and window.returned_articles == 5 and window.split_depth == 0
    (warning,) = coverage_warnings(window_tree(rows, span, 24, 5), 5).collect()
    assert warning.message.endswith("any further ones are left out")
    assert collect_articles(rows, span, 24, 3, tie=("id",)).count() == 3


def test_exactly_full_window_counts_as_truncated(seen):
    span = TimeRange(START, START + timedelta(seconds=1))
    assert adaptive_windows(seen(0, 0), span, None, 2).first().truncated
    assert not adaptive_windows(seen(0), span, None, 2).first().truncated


def test_open_relative_and_empty_ranges(seen):
    rows = seen(0, 5, 100)
    (window,) = adaptive_windows(rows, TimeRange(start=START), 24, 2).collect()
    assert window.truncated and window.end is None and window.split_depth == 0
    relative = TimeRange(timespan="24h", as_of=START + timedelta(hours=1))
    (window,) = adaptive_windows(rows, relative, 24, 2).collect()
    assert window.timespan == "24h" and window.truncated
    assert "window timespan=24h: any" in coverage_warnings(window_tree(rows, relative, 24, 2), 2).first().message
    moment = TimeRange(START, START)
    (window,) = adaptive_windows(rows, moment, 24, 5).collect()
    assert window.start == window.end and window.returned_articles == 1
    (window,) = adaptive_windows(rows, TimeRange(), None, 5).collect()
    assert window.returned_articles == 3 and window.start is None


def test_fixed_windows(spark, seen):
    span = TimeRange(START, START + timedelta(hours=5))
    got = fixed_windows(spark, span, 2).select("index", iso_utc(F.col("start")), iso_utc(F.col("end"))).collect()
    assert [tuple(r) for r in got] == [
        (1, "2024-01-01T00:00:00Z", "2024-01-01T02:00:00Z"),
        (2, "2024-01-01T02:00:00Z", "2024-01-01T04:00:00Z"),
        (3, "2024-01-01T04:00:00Z", "2024-01-01T05:00:00Z"),
    ]
    assert fixed_windows(spark, span, None).count() == 1
    assert fixed_windows(spark, TimeRange(START, START), 2).count() == 1
    at = assign_windows(seen(0, 7200, 7199, 18000, 18001), span, 2).orderBy("id").collect()
    assert [r["index"] for r in at] == [1, 2, 1, 3]  # the end belongs to the last window, beyond it nothing


def test_large_cap_uses_two_cuts_and_keeps_exact_rows(spark, seen):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        rows = seen(*range(200)).withColumn("window_index", F.lit(1))
        got = cap_per_window(rows.repartition(7), 50, [F.col("id")]).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert sorted((r.id, r.position) for r in got) == [(i, i) for i in range(50)]


def test_third_of_all_rows_in_one_second(seen):
    offsets = [i for i in range(600)] + [300] * 300
    span = TimeRange(START, START + timedelta(seconds=600))
    got = adaptive_windows(seen(*offsets), span, 24, 20).collect()
    full = [r for r in got if r.truncated]
    assert len(full) == 1 and full[0].returned_articles == 20
    assert sum(r.returned_articles for r in got) == 599 + 20
