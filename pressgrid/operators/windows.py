"""Time windows: fixed, adaptively halved, capped, and what they say about coverage.

A window that holds ``max_rows`` rows or more is halved until its parts hold fewer, or last under two
seconds. Halving depends on the bounds only, so each second's path through the halves is a function of
its offset. The tree is counted in bands of a few levels, from the bottom: only seconds inside a full window at
the top of a band are unfolded to its levels, and the band above works on one sum for each of these windows.
Nothing runs on the driver, and the articles themselves are reduced to per-second counts first.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressgrid.functions.times import iso_utc
from pressgrid.operators.places import numbered
from pressgrid.operators.predicates import bounds, within
from pressgrid.plans.request import Sort, TimeRange
from pressgrid.sources.staging import STAGES, Stages

SECOND = 1_000_000  # microseconds
_BLOCK_BITS = 16  # ordered work inside a base window is cut into blocks of 2^16 seconds
_BAND = 6  # levels of the window tree that are unfolded together
_SALTS = 64  # parts in which rows that share a cut-off second are first ranked
_LAST = (1 << 63) - 1


def _whole(value: Column, unit: int) -> Column:
    """Integer division that stays exact for microseconds (``/`` on its own rounds large quotients)."""
    return ((value - value % F.lit(unit)) / F.lit(unit)).cast("long")


class _Grid:
    """The base windows of a range as arithmetic on microseconds and, inside a window, on seconds."""

    def __init__(self, date_range: TimeRange, hours: int | None) -> None:
        limits = bounds(date_range)
        self.limits = limits
        self.timespan = date_range.timespan
        self.closed = limits.start is not None and limits.end is not None
        self.total = (limits.end - limits.start) // timedelta(microseconds=1) if self.closed else 0
        if self.total >= SECOND << 31:
            raise ValueError("a time range of more than 68 years cannot be numbered in seconds; leave an end open")
        whole = self.timespan or not self.closed or hours is None or self.total == 0
        self.step = max(self.total, 1) if whole else hours * 3600 * SECOND
        self.size = 1 if whole else -(-self.total // self.step)
        # Open and relative ranges are one window that is never halved.
        self.splits = self.closed and not self.timespan

    def _offset(self, ts: Column) -> Column:
        if not self.closed:
            return F.lit(0).cast("long")
        return F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.lit(self.limits.start))

    def index(self, ts: Column) -> Column:
        # A row at the very end of the range belongs to the last window.
        return F.least(_whole(self._offset(ts), self.step).cast("int"), F.lit(self.size - 1))

    def second(self, ts: Column) -> Column:
        """Whole seconds since the start of the row's base window."""
        return _whole(self._offset(ts) - self.index(ts).cast("long") * F.lit(self.step), SECOND)

    def _length(self, index: Column) -> Column:
        return F.least(F.lit(self.step), F.lit(self.total) - index.cast("long") * F.lit(self.step))

    def seconds(self, index: Column) -> Column:
        """Whole seconds that a base window lasts."""
        return _whole(self._length(index), SECOND)

    def start(self, index: Column, second: Column) -> Column:
        if not self.closed:
            return F.lit(self.limits.start).cast("timestamp")
        origin = F.unix_micros(F.lit(self.limits.start)) + index.cast("long") * F.lit(self.step)
        return F.timestamp_micros(origin + second * F.lit(SECOND))

    def end(self, index: Column, second: Column) -> Column:
        if not self.closed:
            return F.lit(self.limits.end).cast("timestamp")
        origin = F.unix_micros(F.lit(self.limits.start)) + index.cast("long") * F.lit(self.step)
        # The last part of a base window takes in what is left beyond its last whole second.
        length = F.when(second == self.seconds(index), self._length(index)).otherwise(second * F.lit(SECOND))
        return F.timestamp_micros(origin + length)

    @property
    def depth(self) -> int:
        seconds = min(self.step, self.total) // SECOND
        return ceil(log2(seconds)) if self.splits and seconds >= 2 else 0

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.range(self.size).select(F.col("id").cast("int").alias("base"))


def fixed_windows(spark: SparkSession, date_range: TimeRange, hours: int | None = 24) -> DataFrame:
    """Consecutive windows of ``hours`` over the range, the last one possibly shorter.

    A relative or open range, one of zero length, or ``hours=None`` gives a single window.
    """
    grid = _Grid(date_range, hours)
    base = F.col("base")
    return grid.table(spark).select(
        (base + 1).alias("index"),
        grid.start(base, F.lit(0)).alias("start"),
        grid.end(base, grid.seconds(base)).alias("end"),
        F.lit(grid.timespan).cast("string").alias("timespan"),
    )


def assign_windows(
    articles: DataFrame, date_range: TimeRange, hours: int | None = 24, seen: str = "seen_at"
) -> DataFrame:
    """Rows inside the range with the 1-based ``index`` of their fixed window, computed without a join."""
    grid = _Grid(date_range, hours)
    return within(articles, date_range, seen).withColumn("index", grid.index(F.col(seen)) + 1)


def _seconds(articles: DataFrame, grid: _Grid, seen: str) -> DataFrame:
    ts = F.col(seen)
    # The range test has removed nulls; saying so keeps null checks out of the generated code.
    zero = F.lit(0)
    keys = articles.select(
        F.coalesce(grid.index(ts), zero).alias("base"), F.coalesce(grid.second(ts), zero.cast("long")).alias("second")
    )
    return keys.groupBy("base", "second").agg(F.count("*").alias("rows"))


def _path(last: int, size: Column) -> Column:
    """The windows around ``second``, one for each depth below ``last``, of a base window of ``size`` seconds.

    A window of ``size`` seconds has halves of ``size // 2`` and the rest; one under two seconds repeats itself.
    """

    def half_of(node: Column) -> Column:
        middle = node["lo"] + F.shiftright(node["size"], 1)
        right = F.col("second") >= middle
        return F.struct(
            F.when(right, middle).otherwise(node["lo"]).alias("lo"),
            F.shiftright(node["size"] + right.cast("long"), 1).alias("size"),
        )

    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), size.alias("size")))
    depths = F.array(*map(F.lit, range(1, last))).cast("array<int>")
    return F.aggregate(depths, whole, lambda path, _: F.concat(path, F.array(half_of(F.element_at(path, -1)))))


def _band_nodes(units: DataFrame, first: int, last: int) -> DataFrame:
    """Windows of the depths from ``first`` up to below ``last`` with their rows and those of their left halves.

    ``units`` are windows of depth ``last``, or seconds, with the path to them.
    """
    in_left = "CASE WHEN second < node.lo + shiftright(node.size, 1) THEN rows ELSE 0 END"
    band = F.slice("path", first + 1, last - first)
    return (
        units.select("base", "top", "second", "rows", F.posexplode(band).alias("level", "node"))
        .filter("node.size >= 2 OR level = 0")
        .groupBy("base", "top", (F.col("level") + first).alias("depth"), "node.lo", "node.size")
        .agg(F.sum("rows").alias("rows"), F.sum(F.expr(in_left)).alias("left")).drop("top")
    )


def _nodes(seconds: DataFrame, grid: _Grid, max_rows: int) -> DataFrame:
    """(base, depth, lo, size, rows, left) of all full windows, of the base windows, and of some others.

    A band's topmost windows are summed where their seconds lie together; those that are not full are not opened.
    """
    depths = max(grid.depth, 1)
    base_size = grid.seconds(F.col("base"))
    units, found = seconds, None
    for first in reversed(range(0, depths, _BAND)):
        last = min(first + _BAND, depths)
        located = units.select("base", "second", "rows", _path(last, base_size).alias("path"))
        located = located.withColumn("top", F.get("path", F.lit(first))["lo"])
        opened = located
        if first:
            held = F.sum("rows").over(Window.partitionBy("base", "top"))
            opened = located.withColumn("held", held).filter(F.col("held") >= max_rows)
            units = located.groupBy("base", F.col("top").alias("second")).agg(F.sum("rows").alias("rows"))
        nodes = _band_nodes(opened, first, last)
        found = nodes if found is None else found.unionByName(nodes)
    return found


def _tree(seconds: DataFrame, grid: _Grid, max_rows: int | None) -> DataFrame:
    """Every window the halving visits: (base, depth, lo, size, rows, leaf)."""
    # Base windows without rows are visited too.
    empty = grid.table(seconds.sparkSession).select(
        "base", F.lit(0).cast("long").alias("second"), F.lit(0).cast("long").alias("rows")
    )
    depth, lo, size, rows, left = map(F.col, ("depth", "lo", "size", "rows", "left"))
    half = F.shiftright(size, 1)
    seconds = seconds.unionByName(empty)
    if max_rows is None or not grid.splits:
        # Nothing is halved.
        whole = seconds.groupBy("base").agg(F.sum("rows").alias("rows"))
        return whole.select(
            "base", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("lo"), grid.seconds(F.col("base")).alias("size"),
            "rows", F.lit(True).alias("leaf"),
        )
    nodes = _nodes(seconds, grid, max_rows)

    def full(n: Column, length: Column) -> Column:
        return (n >= max_rows) & (length >= 2)

    def window(level: Column, at: Column, length: Column, n: Column, leaf: Column) -> Column:
        return F.struct(
            level.alias("depth"), at.alias("lo"), length.alias("size"), n.alias("rows"), leaf.alias("leaf")
        )

    # A full window is split whatever its ancestors hold, because they hold at least as much. It knows
    # its halves' counts, so halves without rows need no join to appear. Windows that are not full are
    # reported by their parent, except the base windows.
    halves = F.array(
        window(depth + 1, lo, half, left, ~full(left, half)),
        window(depth + 1, lo + half, size - half, rows - left, ~full(rows - left, size - half)),
    )
    itself = F.array(window(depth, lo, size, rows, F.lit(False)))
    alone = F.array(window(depth, lo, size, rows, F.lit(True)))
    emitted = F.when(
        full(rows, size), F.concat(itself, F.filter(halves, lambda part: part["leaf"]))
    ).otherwise(alone)
    return nodes.filter(full(rows, size) | (depth == 0)).select("base", F.inline(emitted))


def _block(second: Column) -> Column:
    return F.shiftright(second, _BLOCK_BITS)


def _numbered(leaves: DataFrame) -> DataFrame:
    """Leaves with their 1-based ``index`` in time order.

    Numbering runs inside blocks of a base window, so that no task orders more than a block; only one count
    per block is summed up globally.
    """
    blocks = leaves.withColumn("block", _block(F.col("lo")))
    counts = blocks.groupBy("base", "block").agg(F.count("*").alias("leaves"))
    before = counts.select(
        "base", "block",
        (F.sum("leaves").over(Window.orderBy("base", "block")) - F.col("leaves")).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("base", "block").orderBy("lo"))
    return (
        blocks.join(before, ["base", "block"])
        .withColumn("index", (F.col("before") + place).cast("int")).drop("before", "block")
    )


def _returned(rows: Column, max_rows: int | None) -> Column:
    return rows if max_rows is None else F.least(rows, F.lit(max_rows).cast("long"))


def _reached(rows: Column, max_rows: int | None) -> Column:
    """Whether a window holds as many rows as are taken from one."""
    return F.lit(False) if max_rows is None else rows >= max_rows


def _window_rows(leaves: DataFrame, grid: _Grid, max_rows: int | None) -> DataFrame:
    base, lo = F.col("base"), F.col("lo")
    return leaves.select(
        "index",
        grid.start(base, lo).alias("start"),
        grid.end(base, lo + F.col("size")).alias("end"),
        F.lit(grid.timespan).cast("string").alias("timespan"),
        _returned(F.col("rows"), max_rows).alias("returned_articles"),
        _reached(F.col("rows"), max_rows).alias("truncated"),
        F.col("depth").cast("int").alias("split_depth"),
        (F.col("depth") > 0).alias("adaptive_split"),
    )


def window_tree(
    articles: DataFrame, date_range: TimeRange, hours: int | None, max_rows: int | None, seen: str = "seen_at"
) -> DataFrame:
    """All windows visited while halving, inner ones and leaves, with bounds and row counts."""
    grid = _Grid(date_range, hours)
    inside = within(articles, date_range, seen)
    tree = _tree(_seconds(inside, grid, seen), grid, max_rows)
    base, lo = F.col("base"), F.col("lo")
    return tree.select(
        "base", F.col("depth").cast("int").alias("depth"), "rows", "leaf",
        grid.start(base, lo).alias("start"), grid.end(base, lo + F.col("size")).alias("end"),
        F.lit(grid.timespan).cast("string").alias("timespan"),
    )


def adaptive_windows(
    articles: DataFrame, date_range: TimeRange, hours: int | None, max_rows: int | None, seen: str = "seen_at"
) -> DataFrame:
    """The window table: leaves of the halving in time order, with their coverage."""
    grid = _Grid(date_range, hours)
    inside = within(articles, date_range, seen)
    leaves = _tree(_seconds(inside, grid, seen), grid, max_rows).filter("leaf")
    return _window_rows(_numbered(leaves), grid, max_rows)


def _spread(rows: DataFrame) -> Column:
    """One of ``_SALTS`` parts, from all of a row's values that can be hashed."""
    plain = [name for name, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    return F.pmod(F.xxhash64(*plain), F.lit(_SALTS))


def _first_rows(rows: DataFrame, groups: Sequence[str], max_rows: int, need: Column, order: Sequence[Column]) -> DataFrame:
    """The first ``need`` (at most ``max_rows``) rows of each group: first of each part of a group, then of what is left."""
    part = F.row_number().over(Window.partitionBy(*groups, "_salt").orderBy(*order))
    whole = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    few = rows.withColumn("_salt", _spread(rows)).withColumn("_place", part).filter(F.col("_place") <= max_rows)
    return few.withColumn("_place", whole).filter(F.col("_place") <= need).drop("_salt", "_place")


def _cuts(keys: DataFrame, groups: Sequence[str], max_rows: int) -> DataFrame:
    """(groups, _cut, _need) of groups beyond ``max_rows``: the key at which they reach it, and how many rows of that key are taken.

    ``keys`` (groups, _key, _rows) are summed along the key: block sums first, then the keys of a block.
    """
    blocks = keys.groupBy(*groups, F.shiftright("_key", _BLOCK_BITS).alias("_block")).agg(F.sum("_rows").alias("_held"))
    over_blocks = F.sum("_held").over(Window.partitionBy(*groups).orderBy("_block"))
    reached = (
        blocks.withColumn("_before", over_blocks - F.col("_held"))
        .filter((F.col("_before") <= max_rows) & (F.col("_before") + F.col("_held") > max_rows))
        .select(*groups, "_block", "_before")
    )
    inside = keys.withColumn("_block", F.shiftright("_key", _BLOCK_BITS)).join(reached, [*groups, "_block"])
    over_keys = F.sum("_rows").over(Window.partitionBy(*groups).orderBy("_key"))
    before = F.col("_before") + over_keys - F.col("_rows")
    return (
        inside.withColumn("_need", F.lit(max_rows) - before)
        .filter((F.col("_need") >= 0) & (F.col("_need") < F.col("_rows")))
        .select(*groups, F.col("_key").alias("_cut"), "_need")
    )


def _cut_rows(rows: DataFrame, cuts: DataFrame, groups: Sequence[str], max_rows: int, order: Sequence[Column]) -> DataFrame:
    """Rows before their group's cut, the rows needed of the cut itself, and all rows of groups without one."""
    marked = rows.join(cuts, [*groups], "left")
    kept = marked.filter(F.col("_cut").isNull() | (F.col("_key") < F.col("_cut"))).drop("_cut", "_need", "_key")
    tied = marked.filter(F.col("_key") == F.col("_cut")).drop("_cut", "_key")
    return kept.unionByName(_first_rows(tied, groups, max_rows, F.col("_need"), order).drop("_need"))


def cap_per_window(
    articles: DataFrame, max_rows: int | None, order: Sequence[Column], window: Sequence[str] = ("window_index",),
    key: Column | None = None, stages: Stages = STAGES,
) -> DataFrame:
    """At most ``max_rows`` rows of each window, in the given order, numbered by ``position``.

    ``key`` is a whole number that never falls along the order, such as the second for date orders. Counts of it, summed along
    each window, give the key at which the window reaches its cap: rows before it are kept and rows beyond it dropped by
    comparison, whatever the cap. Only rows of that one key are ranked, in parts that are dealt out by their values, so that
    no task orders a crowded second by itself; without a key all rows of a crowded window are. Positions are numbered
    among kept rows. With no cap all rows are kept, and numbered by a range-partitioned sort.
    """
    window = list(window)
    if max_rows is None:
        return numbered(articles, order, stages.keep, window, "position").withColumn("position", F.col("position").cast("int"))
    keyed = articles.withColumn("_key", (F.lit(0) if key is None else key).cast("long"))
    counts = keyed.groupBy(*window, "_key").agg(F.count("*").alias("_rows"))
    rows = _cut_rows(keyed, _cuts(counts, window, max_rows), window, max_rows, order)
    place = F.row_number().over(Window.partitionBy(*window).orderBy(*order))
    return rows.withColumn("position", place - 1)


def order_key(sort: Sort, seen: str = "seen_at") -> Column:
    """A whole number that never falls along :func:`remote_order`: seconds, or tone in steps of 1/1024."""
    second = F.unix_seconds(F.col(seen).cast("timestamp"))
    bounded = F.greatest(F.least(F.col("tone"), F.lit(1e12)), F.lit(-1e12))
    tone = F.when(F.col("tone").isNotNull(), F.floor(bounded * 1024))
    match Sort(sort):
        case Sort.OLDEST:
            return F.coalesce(second, F.lit(-_LAST))
        case Sort.TONE_HIGH:
            return F.coalesce(F.when(F.isnan("tone"), F.lit(-_LAST)).otherwise(-tone), F.lit(_LAST))
        case Sort.TONE_LOW:
            return F.when(F.isnan("tone"), F.lit(_LAST - 1)).otherwise(F.coalesce(tone, F.lit(_LAST)))
        case _:
            return F.coalesce(-second, F.lit(_LAST))


def remote_order(sort: Sort, seen: str = "seen_at", tie: Sequence[str] = ("url", "title")) -> list[Column]:
    """Order inside one window. Relevance has no counterpart on tables; newest first stands in for it."""
    first = {
        Sort.RELEVANCE: F.col(seen).desc_nulls_last(),
        Sort.NEWEST: F.col(seen).desc_nulls_last(),
        Sort.OLDEST: F.col(seen).asc_nulls_first(),
        Sort.TONE_HIGH: F.col("tone").desc_nulls_last(),
        Sort.TONE_LOW: F.col("tone").asc_nulls_last(),
    }[Sort(sort)]
    return [first, *(F.col(c).asc_nulls_last() for c in tie)]


def collect_articles(
    articles: DataFrame,
    date_range: TimeRange,
    hours: int | None,
    max_rows: int | None,
    sort: Sort = Sort.RELEVANCE,
    seen: str = "seen_at",
    tie: Sequence[str] = ("url", "title"),
    stages: Stages = STAGES,
) -> DataFrame:
    """Rows of all leaf windows, each capped at ``max_rows``, in fetch order; without a cap all rows of the range.

    ``window_index`` is the second, counted from the start of the range, at which the row's leaf begins, and
    ``position`` the row's place inside it. A second is matched to its leaf among the seconds and leaves of
    one block; the articles then look their second up by equality.
    """
    grid = _Grid(date_range, hours)
    inside = within(articles, date_range, seen).drop("window_index", "position")
    ts, order = F.col(seen), remote_order(sort, seen, tie)
    if max_rows is None or not grid.splits:
        begins = grid.index(ts).cast("long") * F.lit(grid.step // SECOND)
        placed = inside.withColumn("window_index", F.coalesce(begins, F.lit(0)).cast("int"))
        return cap_per_window(placed, max_rows, order, key=order_key(sort, seen), stages=stages)
    seconds = _seconds(inside, grid, seen)
    leaves = _tree(seconds, grid, max_rows).filter("leaf")
    # A leaf marks every block it reaches into, so that each block can be searched on its own.
    reach = F.sequence(_block(F.col("lo")), _block(F.col("lo") + F.col("size")))
    marks = leaves.select(
        "base", F.explode(reach).alias("block"), F.col("lo").alias("second"), F.col("lo").alias("leaf"),
        F.lit(0).alias("kind"),
    ).unionByName(seconds.select(
        "base", _block(F.col("second")).alias("block"), "second", F.lit(None).cast("long").alias("leaf"),
        F.lit(1).alias("kind"),
    ))
    latest = F.last("leaf", ignorenulls=True).over(
        Window.partitionBy("base", "block").orderBy("second", "kind")
    )
    begins = F.col("base").cast("long") * F.lit(grid.step // SECOND) + F.col("leaf")
    lookup = (
        marks.withColumn("leaf", latest).filter("kind = 1")
        .select(F.col("base").alias("_base"), F.col("second").alias("_second"), begins.cast("int").alias("window_index"))
    )
    keyed = inside.withColumn("_base", grid.index(ts)).withColumn("_second", grid.second(ts))
    # Only a second can hold more than the cap, as any longer window would have been halved. Cutting it here keeps a
    # crowded second from reaching the join.
    crowded = seconds.filter(F.col("rows") > max_rows).select(
        F.col("base").alias("_base"), F.col("second").alias("_second"), F.lit(0).cast("long").alias("_cut"),
        F.lit(max_rows).cast("long").alias("_need"),
    )
    keyed = _cut_rows(keyed.withColumn("_key", F.lit(0).cast("long")), crowded, ["_base", "_second"], max_rows, order)
    placed = keyed.join(lookup, ["_base", "_second"]).drop("_base", "_second")
    place = F.row_number().over(Window.partitionBy("window_index").orderBy(*order))
    return placed.withColumn("position", place - 1).filter(F.col("position") < max_rows)


def coverage_summary(
    tree: DataFrame, deduplicated: DataFrame, max_rows: int | None, hours: int | None = 24, deduplicate: bool = True
) -> DataFrame:
    """One row of totals over a :func:`window_tree` and the articles left after deduplication."""
    kept = deduplicated.select(
        F.lit(None).cast("int").alias("base"), F.lit(None).cast("int").alias("depth"),
        F.lit(None).cast("long").alias("rows"), F.lit(None).cast("boolean").alias("leaf"),
    )
    both = tree.select("base", "depth", "rows", "leaf").unionByName(kept)
    leaf, inner = F.col("leaf"), ~F.col("leaf")
    returned = F.when(leaf, _returned(F.col("rows"), max_rows))
    totals = both.agg(
        F.count_if(F.col("depth") == 0).alias("base_windows"),
        F.count_if(leaf).alias("batch_count"),
        F.count("leaf").alias("fetch_attempt_count"),
        F.count_if(inner).alias("split_window_count"),
        F.coalesce(F.sum(returned), F.lit(0)).alias("raw_article_count"),
        F.count_if(F.col("leaf").isNull()).alias("deduplicated_article_count"),
        F.count_if(leaf & _reached(F.col("rows"), max_rows)).alias("truncated_window_count"),
    )
    removed = F.col("raw_article_count") - F.col("deduplicated_article_count")
    return totals.select(
        ((F.col("base_windows") > 1) | (F.col("split_window_count") > 0)).alias("batching_enabled"),
        F.lit(hours).cast("int").alias("batch_window_hours"),
        "batch_count", "fetch_attempt_count", "split_window_count", "raw_article_count",
        "deduplicated_article_count",
        (removed if deduplicate else F.lit(0).cast("long")).alias("duplicates_removed"),
        "truncated_window_count",
    )


def coverage_warnings(tree: DataFrame, max_rows: int | None) -> DataFrame:
    """One message per full window of a :func:`window_tree`, ordered as a depth-first walk meets them."""
    described = F.coalesce(
        F.concat(F.lit("timespan="), F.col("timespan")),
        F.concat(
            F.coalesce(iso_utc(F.col("start")), F.lit("None")), F.lit(" to "),
            F.coalesce(iso_utc(F.col("end")), F.lit("None")),
        ),
    )
    outcome = F.when(F.col("leaf"), F.lit("any further ones are left out")).otherwise(F.lit("it is read in halves"))
    return (
        tree.filter(_reached(F.col("rows"), max_rows))
        .select(
            "start", F.col("depth").alias("split_depth"),
            F.concat(F.lit(f"{max_rows} articles or more in the window "), described, F.lit(": "), outcome).alias("message"),
        )
        .orderBy("start", "split_depth")
    )
