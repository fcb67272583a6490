"""Approximate nearest neighbours by cross-polytope hashing, with exact reranking."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, StructField, StructType

#: Hash tables, buckets probed in each, and axes of the second hash (a power of two). At 64 dimensions these find 0.99 of
#: the five nearest at a cosine of 0.45, 0.95 at 0.3 (few rows), and look at less than half of the rows.
TABLES, PROBES, SECOND_AXES = 16, 40, 4
SEED = 7
#: Best axes of each of the two hashes that probes are combined from.
DEPTH = 12
#: Vectors of a bucket that one product holds at most, and probing queries.
BUCKET_ROWS, BUCKET_QUERIES = 4096, 4096
#: Bytes of vectors that a group indexes about, queries that it searches at a time (of a quarter of the bytes at most), and
#: vectors that are worth a group of their own.
GROUP_BYTES, GROUP_QUERIES, LEAST_ROWS = 1 << 27, 1 << 15, 1 << 16
#: Pairs of a group that wait for their exact cosine, or else fewer queries are searched at a time.
PAIRS = 1 << 22
#: Tables whose own buckets are searched before all others.
OWN = 4


@lru_cache(maxsize=4)
def _signs(tables: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), size=(tables, 2, 3, width))


def _hadamard(columns: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each column, scaled to keep lengths."""
    width, count = columns.shape
    step, spare = 1, np.empty_like(columns)
    while step < width:
        pairs, turned = columns.reshape(-1, 2, step, count), spare.reshape(-1, 2, step, count)
        np.add(pairs[:, 0], pairs[:, 1], out=turned[:, 0])
        np.subtract(pairs[:, 0], pairs[:, 1], out=turned[:, 1])
        columns, spare = spare, columns
        step *= 2
    columns /= np.sqrt(width)
    return columns


@lru_cache(maxsize=64)
def _rotation(width: int, table: int, part: int, seed: int, tables: int) -> np.ndarray:
    """The three pseudo-rotations of a hash as one matrix."""
    turned = np.eye(width)
    for flip in _signs(tables, width, seed)[table, part]:
        turned = _hadamard(turned * flip[:, None])
    return turned


def _turned(units: np.ndarray, table: int, part: int, seed: int, tables: int, axes: int, exact: bool) -> np.ndarray:
    """Coordinates of each unit vector (a column) along the axes after three pseudo-rotations."""
    if not exact and len(units) <= 256:
        return _rotation(len(units), table, part, seed, tables)[:axes] @ units
    turned = units
    for flip in _signs(tables, len(units), seed)[table, part]:
        turned = _hadamard(turned * flip[:, None])
    return turned[:axes]


def _likeliest(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The signed axis (first all positive ones, then all negative) nearest to each column, and by how much."""
    size, at = np.abs(turned), np.arange(turned.shape[1])
    most, least = turned.argmax(axis=0), turned.argmin(axis=0)
    nearest = np.where(turned[most, at] >= -turned[least, at], most, least + len(turned))
    axis = nearest % len(turned)
    best = size[axis, at]
    size[axis, at] = -1
    return nearest, best - size.max(axis=0)


def _ascending(cost: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``count`` least of each row in order, ties to the smaller place; and the least step between them and to the next."""
    order = np.argsort(cost, axis=1)
    value = np.take_along_axis(cost, order[:, : count + 1], axis=1)
    step = np.diff(value, axis=1, append=np.inf).min(axis=1)
    tied = step == 0
    if tied.any():
        order[tied] = np.argsort(cost[tied], axis=1, kind="stable")
    return order[:, :count], step


def probes(
    units: np.ndarray, table: int, count: int, tables: int = TABLES, second: int = SECOND_AXES, seed: int = SEED, exact: bool = False,
):
    """The ``count`` likeliest buckets of each unit vector in one table, its own first.

    Unless ``exact``, vectors are turned by a matrix, and only those whose axes are too close to call by steps.
    """
    width, columns = units.shape[1], np.ascontiguousarray(units.T)
    first = _turned(columns, table, 0, seed, tables, width, exact)
    other = _turned(columns, table, 1, seed, tables, min(second, width), exact)
    if count == 1:
        (nearest, gap), (after, other_gap) = _likeliest(first), _likeliest(other)
        found, sure = (nearest * (2 * len(other)) + after)[:, None], np.minimum(gap, other_gap)
    else:
        best, gaps, steps = [], [], []
        for side in (first, other):
            away = np.concatenate([-side, side]).T.copy()
            order, step = _ascending(away, DEPTH)
            value = -np.take_along_axis(away, order, axis=1)
            best.append(order)
            gaps.append((value[:, :1] - value) ** 2)
            steps.append(step)
        keys = (best[0][:, :, None] * (2 * len(other)) + best[1][:, None, :]).reshape(len(units), -1)
        cost = (gaps[0][:, :, None] + gaps[1][:, None, :]).reshape(len(units), -1)
        order, step = _ascending(cost, count)
        found, sure = np.take_along_axis(keys, order, axis=1), np.minimum.reduce([*steps, step])
    if not exact:
        close = np.flatnonzero(sure < width * 1e-13)
        if len(close):
            found[close] = probes(units[close], table, count, tables, second, seed, True)
    return found


def _units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, filled up with zeros to a power of two."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
    width = 1 << max(vectors.shape[1] - 1, 0).bit_length()
    return np.pad(scaled, ((0, 0), (0, width - vectors.shape[1])))


def cosines(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines in double precision on the vectors as they are."""
    lengths = np.sqrt((queries**2).sum(axis=1))[:, None] * np.sqrt((rows**2).sum(axis=1))[None, :]
    return np.einsum("qd,rd->qr", queries, rows) / lengths


def _pair_cosines(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The ``cosines`` of each query with the row in its place."""
    queries, rows = queries.astype(np.float64), rows.astype(np.float64)
    return np.einsum("nd,nd->n", queries, rows) / (np.sqrt((queries**2).sum(axis=1)) * np.sqrt((rows**2).sum(axis=1)))


def _at_once(size: int) -> int:
    """Queries of so many bytes each that are searched at a time."""
    return max(1, min(GROUP_QUERIES, GROUP_BYTES // (4 * size)))


def _blocks(vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, len(vectors), 512):
        yield at, _units(vectors[at : at + 512].astype(np.float64))


def _runs(buckets: np.ndarray) -> dict[int, tuple[int, int]]:
    """Where each bucket begins and ends in sorted buckets."""
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
    return dict(zip(buckets[starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(buckets)])))


class _Crowded(Exception):
    """More pairs than can wait."""


class _Index:
    """Vectors of one length, each once, by their buckets in every table."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, tables: int, probe: int, second: int):
        high, low = keys.view(np.uint64).T
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        order = np.sort(order[np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]])
        self.keys, self.vectors = (keys, vectors) if len(order) == len(keys) else (keys[order], vectors[order])
        self.tables, self.probe, self.second, self.spare = tables, probe, second, None
        width = 1 << max(vectors.shape[1] - 1, 0).bit_length()
        #: A bucket's number, as small as it can be: there is one for each query, table and probe.
        self.kind = np.uint16 if 4 * width * min(second, width) <= 1 << 16 else np.int64
        self.width, self.scale = width, np.empty((len(self.keys), 1))
        buckets = np.empty((tables, len(self.keys)), dtype=self.kind)
        for at, units in _blocks(self.vectors):
            part = self.vectors[at : at + len(units)].astype(np.float64)
            self.scale[at : at + len(units), 0] = 1 / np.sqrt((part**2).sum(axis=1))
            for table in range(tables):
                buckets[table, at : at + len(units)] = probes(units, table, 1, tables, second)[:, 0]
        self.at_once = _at_once(vectors.shape[1] * vectors.itemsize)
        self.rows, self.runs = [], []
        for own in buckets:
            order = np.argsort(own, kind="stable")
            self.rows.append(order.astype(np.int32))
            self.runs.append(_runs(own[order].astype(np.int64)))

    def nearest(self, vectors: np.ndarray, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``_nearest`` of all queries, fewer at a time if very many vectors lie about as near."""
        at = 0
        while at < len(vectors):
            try:
                query, row, score = self._nearest(vectors[at : at + self.at_once], keep)
            except _Crowded:
                self.at_once = min(self.at_once, len(vectors) - at) // 2
                continue
            yield at + query, row, score
            at += self.at_once

    def _nearest(self, vectors: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and cosine of the ``keep`` nearest vectors in the buckets of each query (and those that tie with the last).

        Products in single precision leave out what is surely farther than the nearest so far; whatever they leave is
        ranked by its exact cosine. A query's own buckets of some tables come first, as they hold most of its nearest.
        """
        units = np.empty((len(vectors), vectors.shape[1]), dtype=np.float32)
        buckets = None
        for at, part in _blocks(vectors):
            units[at : at + len(part)] = part[:, : vectors.shape[1]]
            for table in range(self.tables):
                found = probes(part, table, self.probe, self.tables, self.second)
                if buckets is None:
                    buckets = np.empty((self.tables, len(vectors), found.shape[1]), dtype=self.kind)
                buckets[table, at : at + len(part)] = found
        slack = np.float32((self.width + 16) * 2.0**-23)  # twice the most that a product can be off
        least, low = np.full(len(vectors), -2.0), np.full(len(vectors), -3.0, dtype=np.float32)
        best, pairs = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)), []
        steps = [(table, slice(0, 1)) for table in range(min(OWN, self.tables))]
        steps += [(table, slice(int(table < OWN), None)) for table in range(self.tables)]
        for n, (table, probed) in enumerate(steps, 1):
            pairs += self._candidates(units, buckets[table][:, probed], table, n <= OWN, low, slack, keep)
            if n in (OWN, len(steps)) or sum(len(x[0]) for x in pairs) > keep * len(vectors):
                best, pairs = self._merged(best, pairs, vectors, least, low, keep), []
                np.maximum(low, least - slack, out=low, casting="same_kind")
        return best

    def _candidates(self, units: np.ndarray, buckets: np.ndarray, table: int, own: bool, low: np.ndarray, slack: np.float32, keep: int) -> list:
        """Pairs in the buckets of one table that may be among the nearest: queries, rows and their products.

        ``low``: what a product must reach for each query; rises with the products seen, if ``own`` buckets are searched.
        """
        order = np.argsort(buckets, axis=None, kind="stable")
        asking = (order // max(buckets.shape[1], 1)).astype(np.int32)
        found, waiting, runs, rows, width = [], 0, self.runs[table], self.rows[table], units.shape[1]
        if self.spare is None:
            self.spare = [np.empty(n, dtype=np.float32) for n in (BUCKET_ROWS * width, BUCKET_QUERIES * width, BUCKET_ROWS * BUCKET_QUERIES)]
            self.reach = np.empty(BUCKET_ROWS * BUCKET_QUERIES, dtype=bool)
        for bucket, (start, end) in _runs(buckets.ravel()[order].astype(np.int64)).items():
            if bucket not in runs:
                continue
            first, last = runs[bucket]
            for r in range(first, last, BUCKET_ROWS):
                held = rows[r : min(r + BUCKET_ROWS, last)]
                side = self.spare[0][: len(held) * width].reshape(-1, width)
                np.multiply(self.vectors[held], self.scale[held], out=side, casting="same_kind")
                for q in range(start, end, BUCKET_QUERIES):
                    asked = asking[q : min(q + BUCKET_QUERIES, end)]
                    other = units.take(asked, axis=0, out=self.spare[1][: len(asked) * width].reshape(-1, width), mode="clip")
                    score = np.matmul(side, other.T, out=self.spare[2][: len(held) * len(asked)].reshape(len(held), -1))
                    bound = low[asked]
                    if len(held) > keep and (own or bound.min() < -2):
                        bound = np.maximum(bound, np.partition(score.T, -keep, axis=1)[:, -keep] - slack)
                        low[asked] = bound
                    reach = np.greater_equal(score, bound, out=self.reach[: score.size].reshape(score.shape))
                    if len(near := np.flatnonzero(reach)):
                        to, at = np.divmod(near, len(asked))
                        found.append((asked[at], held[to], score.ravel()[near]))
                        waiting += len(near)
                        if waiting > PAIRS and len(units) > 1:
                            raise _Crowded
        return found

    def _merged(self, best: tuple, pairs: list, vectors: np.ndarray, least: np.ndarray, low: np.ndarray, keep: int) -> tuple:
        """``best`` with the pairs that reach it; ``least`` of each query rises to its last cosine that is kept."""
        if not pairs:
            return best
        query, row, product = (np.concatenate(column) for column in zip(*pairs))
        near = product >= low[query]
        pairs = np.sort(query[near].astype(np.int64) * len(self.keys) + row[near])
        known = np.sort(best[0] * len(self.keys) + best[1])
        fresh = np.diff(pairs, prepend=-1) != 0
        if len(known):
            fresh &= known[np.minimum(np.searchsorted(known, pairs), len(known) - 1)] != pairs
        query, row = np.divmod(pairs[fresh], len(self.keys))
        score = np.empty(len(query))
        for at in range(0, len(query), 8192):
            part = slice(at, at + 8192)
            score[part] = _pair_cosines(vectors[query[part]], self.vectors[row[part]])
        near = score >= least[query]
        query, row, score = (np.concatenate([x, y[near]]) for x, y in zip(best, (query, row, score)))
        order = np.lexsort((-score, query))
        query, row, score = query[order], row[order], score[order]
        starts = np.flatnonzero(np.diff(query, prepend=-1))
        full = starts[np.diff(starts, append=len(query)) >= keep]
        least[query[full]] = score[full + keep - 1]
        near = score >= least[query]
        return query[near], row[near], score[near]


def _packed(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Each vector's key, with its bytes (a vector once a batch) or its id."""
    for batch in batches:
        vectors = batch.column(batch.schema.get_field_index("embedding"))
        values = np.ascontiguousarray(vectors.flatten().to_numpy(zero_copy_only=False))
        ends = np.r_[0, np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)] * values.itemsize
        data, at = values.view(np.uint8).data, ends.tolist()
        keys = [hashlib.md5(data[start:end], usedforsecurity=False).digest() for start, end in zip(at, at[1:])]
        if not whole:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(batch.schema.get_field_index("id"))], ["key", "id"])
            continue
        packed = pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])
        first = {key: n for n, key in reversed(list(enumerate(keys)))}
        out = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), packed], ["key", "vector"])
        yield out if len(first) == len(keys) else out.take(pa.array(sorted(first.values())))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column, and where each value begins and the last ends."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _keys(values: np.ndarray) -> pa.Array:
    """A column of keys of 16 bytes."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * 16
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])


def _by_length(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Keys and vectors of a batch, by the vectors' length."""
    keys = _bytes(batch.column("key"))[0].reshape(-1, 16)
    data, ends = _bytes(batch.column("vector"))
    sizes = np.diff(ends)
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        part = data.reshape(-1, size) if len(own) == len(sizes) else data[ends[own][:, None] + np.arange(size)]
        # copies, so that no batch is held
        vectors = np.frombuffer(bytearray(part), dtype=kind).reshape(len(own), -1)
        if kind == "<f8":  # by a power of two where squares would leave the range of doubles
            most = np.frexp(np.abs(vectors).max(axis=1))[1]
            far = np.flatnonzero(np.abs(most) > 300)
            vectors[far] = np.ldexp(vectors[far], -most[far, None])
        yield size, keys[own], vectors


def _searched(batches: Iterator[pa.RecordBatch], keep: int, tables: int, probe: int, second: int, kind: str) -> Iterator[pa.RecordBatch]:
    """The nearest of each query among the vectors of its group; groups come one after the other, their vectors first."""
    group, index, held, waiting = None, {}, {}, {}

    def answers(size: int) -> Iterator[pa.RecordBatch]:
        own = waiting.pop(size, None)
        if own is None or size not in index:
            return
        keys, vectors = (np.concatenate(column) for column in zip(*own))
        for query, row, score in index[size].nearest(vectors, keep):
            for n in range(0, len(query), 1 << 16):
                part = slice(n, n + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [_keys(keys[query[part]]), _keys(index[size].keys[row[part]]), pa.array(score[part])], ["query", "key", "score"]
                )

    for batch in batches:
        number, asks = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("part", "asks"))
        cuts = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (asks[1:] != asks[:-1])]) if len(number) else []
        for start, end in zip(cuts, [*cuts[1:], len(number)]):
            if number[start] != group:
                for size in list(waiting):
                    yield from answers(size)
                group, index, held, waiting = number[start], {}, {}, {}
            for size, keys, vectors in _by_length(batch.slice(start, end - start), kind):
                if not asks[start]:
                    held.setdefault(size, []).append((keys, vectors))
                    continue
                if size in held:
                    keys_in, vectors_in = (np.concatenate(column) for column in zip(*held.pop(size)))
                    index[size] = _Index(keys_in, vectors_in, tables, probe, second)
                    del keys_in, vectors_in
                waiting.setdefault(size, []).append((keys, vectors))
                if sum(len(x) for x, _ in waiting[size]) >= _at_once(size):
                    yield from answers(size)
    for size in list(waiting):
        yield from answers(size)


def usable(embedding: Column) -> Column:
    """Whether a vector takes part: not null, not empty, not zero, all components finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
    tables: int = TABLES, probe: int = PROBES, second: int = SECOND_AXES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest rows found for each query row, by cosine.

    A pseudo-rotation (three sign flips with Hadamard transforms) takes a unit vector to its nearest signed axis; two
    such hashes make a bucket. Every vector is indexed once a table, every query probes its likeliest buckets, and
    candidates are ranked by their exact cosine in double precision, ties to the smaller id. Equal vectors are indexed
    once, with their ``k`` + 1 smallest ids, which loses no answer; queries with equal vectors are searched once. The
    vectors are dealt by a hash to groups of bounded size, each shuffled once, and every group holds its own buckets;
    queries are shuffled once a group and pass by in turn. Vectors that are not ``usable``, or rows without
    an id, take no part. Only vectors of one length are compared. Repeated ids count as one row each: a row is not its
    own candidate, and neither are others of the same id. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    held = vectors.schema[vector_column].dataType
    single = isinstance(held, ArrayType) and isinstance(held.elementType, FloatType)
    rows = vectors.select(
        F.col(id_column).alias("id"), F.col(vector_column).cast("array<float>" if single else "array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter(F.col("id").isNotNull() & usable(F.col("embedding")))
    named = StructType([StructField("key", BinaryType()), StructField("id", rows.schema["id"].dataType)])
    ranked = rows.select("id", "embedding").mapInArrow(lambda b: _packed(b, False), named).distinct().withColumn(
        "place", F.row_number().over(Window.partitionBy("key").orderBy("id"))
    ).filter(F.col("place") <= k + 1)
    shape = "key binary, vector binary"
    index = rows.select("embedding").mapInArrow(lambda b: _packed(b, True), shape)
    queries = rows.filter("asks").select("embedding").mapInArrow(lambda b: _packed(b, True), shape).distinct()

    # as many groups as tasks may be, if each has some vectors and the queries of all together are half as many as the vectors
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = vectors.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_query).alias("queries"),
        F.coalesce(F.sum(F.size(F.col(vector_column))), F.lit(0)).alias("components"),
    )
    parts = counted.select(F.greatest(
        F.lit(1), F.ceil(F.col("components") / (GROUP_BYTES // (4 if single else 8))), F.least(
            F.lit(partitions), F.ceil(F.col("rows") / LEAST_ROWS),
            F.greatest(F.lit(8), F.floor(F.col("rows") / F.greatest(F.lit(1), 2 * F.col("queries")))),
        ),
    ).cast("int").alias("parts"))
    dealt = index.crossJoin(parts).select(F.pmod(F.xxhash64("key"), "parts").cast("int").alias("part"), F.lit(False).alias("asks"), "key", "vector")
    asked = queries.crossJoin(parts).select(
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"), "key", "vector",
    )
    kind = "<f4" if single else "<f8"
    found = dealt.unionByName(asked).repartitionById(partitions, F.col("part")).sortWithinPartitions("part", "asks").mapInArrow(
        lambda b: _searched(b, k + 1, tables, probe, second, kind), "query binary, key binary, score double"
    )
    # a vector is in one group only
    best = found.withColumn("place", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score"))))
    best = best.filter(F.col("place") <= k + 1).drop("place")
    # ids of the candidates first, then one short list for each distinct query vector
    listed = best.join(ranked.select("key", "id"), "key").withColumn(
        "place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    ).filter(F.col("place") <= k + 1).select(F.col("query").alias("key"), F.struct("score", "id").alias("near"))
    lists = listed.groupBy("key").agg(F.collect_list("near").alias("near"))
    asking = rows.filter("asks").select("id", "embedding").mapInArrow(lambda b: _packed(b, False), named).withColumnRenamed("id", "query_id")
    each = asking.join(lists, "key").select("query_id", F.slice(F.array_sort(
        F.filter("near", lambda x: x["id"] != F.col("query_id")),
        lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1)
        .when(x["id"] < y["id"], -1).when(x["id"] > y["id"], 1).otherwise(0),
    ), 1, k).alias("near"))
    return each.select("query_id", F.posexplode("near").alias("at", "near")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("near.id").alias("vec_id"),
        F.col("near.score").alias("score"),
    )
