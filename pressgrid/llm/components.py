"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgrid.sources.staging import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """Columns ``node``, ``root`` for every node of ``edges`` (two columns of one type) but the roots themselves.

    A root is the least node of its component. Edges turn into stars by alternating large-star and small-star steps;
    each round is written to the shared folder, so the plan stays short and a lost executor costs its own tasks. A hot
    node is only ever grouped by partial aggregation and joined, never gathered. Loops and nulls are dropped; no edges
    give no rows.
    """
    a, b = edges.columns
    whole = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    known = stage(whole.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    before = _state(known)
    while before[0]:
        known = stage(_small_star(_large_star(known).distinct()).distinct(), "edges")
        now = _state(known)
        if now == before:
            break
        before = now
    return known.select(F.col("a").alias("node"), F.col("b").alias("root"))
