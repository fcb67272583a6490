"""Places of rows in a complete order, found without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PART_ROWS = 33  # bits that Spark leaves for rows of a partition in its row numbers


def numbered(
    rows: DataFrame, order: Sequence[Column], keep: Callable[[DataFrame], DataFrame], within: Sequence[str] = (),
    place: str = "place", total: str | None = None,
) -> DataFrame:
    """``rows`` with each one's ``place`` from 0, in ``order``, among those that agree in ``within``.

    A range-partitioned sort lays the rows out, so that a group holding most of them lies over many tasks; a place is
    counted inside the partition and moved by the group's rows in the partitions before, of which there is one number
    for each partition and group. ``keep`` must hold the sorted rows (as a persisted or a written table), since places and
    counts have to come from one layout. ``total`` names a column for the size of the group. ``order`` should be
    complete: rows that it does not tell apart cannot be spread. Nulls of ``within`` form a group of their own.
    """
    laid = keep(rows.orderBy(*(F.asc(c) for c in within), *order).withColumns({
        "_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id() % (1 << _PART_ROWS),
    }))
    runs = laid.groupBy("_part", *within).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    size = F.col("_size")
    if within:
        before = F.sum("_rows").over(Window.partitionBy(*within).orderBy("_part")) - F.col("_rows")
        moves = runs.select(
            "_part", *within, (before - F.col("_first")).alias("_move"),
            F.sum("_rows").over(Window.partitionBy(*within)).alias("_size"),
        )
    else:
        moves = _running(runs)
    keys = ["_part", *within]
    moves = moves.withColumnsRenamed({key: f"_of{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_of{key}")) for key in keys]
    found = laid.join(moves, same).withColumn(place, F.col("_at") + F.col("_move"))
    if total:
        found = found.withColumn(total, size)
    return found.drop("_part", "_at", "_move", "_size", *(f"_of{key}" for key in keys))


def _running(runs: DataFrame) -> DataFrame:
    """Rows of all partitions before each one: as one list, which has an entry a partition."""
    entry = F.struct("_part", "_rows")
    listed = runs.agg(F.array_sort(F.collect_list(entry)).alias("all"))
    sums = F.aggregate(
        "all", F.array(F.lit(0).cast("long")),
        lambda done, run: F.concat(done, F.array(F.element_at(done, -1) + run["_rows"])),
    )
    moves = F.transform("all", lambda run, at: F.struct(
        run["_part"].alias("_part"), F.get("sums", at).alias("_move"), F.element_at(F.col("sums"), -1).alias("_size"),
    ))
    return listed.withColumn("sums", sums).select(F.inline(moves))
