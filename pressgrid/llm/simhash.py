"""Near duplicates by SimHash fingerprints, found with vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pressgrid.llm.components import connected
from pressgrid.sources.staging import stage

SEED = 42
#: Fingerprints compared directly; larger sets are split by distance first.
LEAF = 512
#: Fingerprints that the shape of the routing tree is taken from.
TREE_SAMPLE = 2048


def simhash(text: str | None, width: int = 4) -> int:
    """The 64-bit fingerprint of a text as a signed integer; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(words, lambda end, word: end + 1 + len(word), initial=-1))
    if len(words) < width:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        hashes = [xxhash.xxh64_intdigest(line[at + 1 : end], SEED) for at, end in zip(ends, ends[width:])]
    values = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(values[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<i8")[0])


def fingerprint(text: Column | str, width: int = 4) -> Column:
    """``simhash`` as a column."""

    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(x, width) for x in texts], dtype="int64")

    return of(text)


class _Node:
    """A vantage point with the distance that splits what lies below it; without one, a leaf."""

    def __init__(self, sample: np.ndarray, depth: int, path: int = 1):
        self.path, self.vantage = path, None
        if depth and len(sample) > 1:
            far = np.bitwise_count(sample ^ sample[0])
            self.vantage, self.radius = int(sample[0].view(np.int64)), int(np.median(far))
            self.inner = _Node(sample[far <= self.radius][1:], depth - 1, 2 * path)
            self.outer = _Node(sample[far > self.radius], depth - 1, 2 * path + 1)

    def visited(self, value: Column, reach: int) -> Column:
        """Leaves that may hold a value within ``reach``: the home leaf, and those across a boundary that is near."""
        if self.vantage is None:
            return F.array(F.lit(self.path))
        far, none = F.bit_count(value.bitwiseXOR(F.lit(self.vantage))), F.array().cast("array<int>")
        return F.concat(
            F.when(far <= self.radius + reach, self.inner.visited(value, reach)).otherwise(none),
            F.when(far > self.radius - reach, self.outer.visited(value, reach)).otherwise(none),
        )


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i and j pairwise; ``label`` maps each member to the least member of its set."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(shorter := label[label], label):
            label[:] = shorter


def _near(values: np.ndarray, left: np.ndarray, right: np.ndarray, reach: int, label: np.ndarray) -> None:
    for a in range(0, len(left), LEAF):
        for b in range(0, len(right), LEAF):
            p, q = left[a : a + LEAF], right[b : b + LEAF]
            i, j = np.nonzero(np.bitwise_count(values[p][:, None] ^ values[q][None, :]) <= reach)
            _merge(label, p[i], q[j])


def sets_within(values: np.ndarray, reach: int) -> np.ndarray:
    """For sorted distinct fingerprints, the place of the least one linked to each, by a vantage-point tree."""
    label = np.arange(len(values))
    todo = [label.copy()]
    while todo:
        part = todo.pop()
        if len(part) <= LEAF:
            _near(values, part, part, reach, label)
            continue
        far = np.bitwise_count(values[part] ^ values[part[0]]).astype(np.int16)
        radius = np.median(far)
        inner, outer = part[far <= radius], part[far > radius]
        if not len(outer):  # all equally far: distances to this vantage point tell nothing
            half = len(part) // 2
            inner, outer = part[:half], part[half:]
            _near(values, inner, outer, reach, label)
        else:  # triangle bound: a pair across the boundary has both ends within reach of it
            _near(values, part[(far <= radius) & (far > radius - reach)], part[(far > radius) & (far <= radius + reach)],
                  reach, label)
        todo += [inner, outer]
    return label


def _links(batches: Iterator[pd.DataFrame], reach: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by shard and fingerprint -> (fingerprint, least linked fingerprint of the shard)."""
    rest = pd.DataFrame()

    def done(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        shard = rows[["leaf", "block", "part"]].to_numpy()
        values = rows["fingerprint"].to_numpy(dtype=np.int64)
        cuts = np.flatnonzero((shard[1:] != shard[:-1]).any(axis=1)) + 1
        for at, end in zip([0, *cuts], [*cuts, len(values)]):
            if end - at > 1:
                own = np.unique(values[at:end])
                least = sets_within(own.view(np.uint64), reach)
                moved = least != np.arange(len(own))
                if moved.any():
                    found.append(pd.DataFrame({"a": own[moved], "b": own[least[moved]]}))
        return pd.concat(found) if found else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    for batch in batches:
        rows = pd.concat([rest, batch], ignore_index=True)
        if not len(rows):
            continue
        last = (rows[["leaf", "block", "part"]] == rows[["leaf", "block", "part"]].iloc[-1]).all(axis=1).to_numpy()
        first = len(rows) - int(np.argmin(last[::-1])) if not last.all() else 0
        rest = rows.iloc[first:]
        if first:
            yield done(rows.iloc[:first])
    if len(rest):
        yield done(rest)


def hamming_links(prints: DataFrame, reach: int = 4, depth: int = 2) -> DataFrame:
    """Links (``a``, ``b``) that join all distinct ``fingerprint`` values at ``reach`` or fewer differing bits.

    A vantage-point tree, shaped by a bounded sample, deals fingerprints to leaves by their Hamming distance; each also
    visits every leaf that begins within ``reach`` of it, so a close pair always shares a leaf. Inside a leaf, values at
    ``reach`` bits or fewer agree in one of ``reach`` + 1 blocks of bits, and such shards are searched with a local tree
    that prunes by the triangle bound. Links are exact; a shard gives a spanning set of them, never all of its pairs.
    """
    values = prints.select("fingerprint").filter("fingerprint is not null").distinct()
    rows = values.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(TREE_SAMPLE).collect()
    tree = _Node(np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64), depth)
    cuts = [64 * k // (reach + 1) for k in range(reach + 2)]
    value = F.col("fingerprint")
    blocks = F.array(*[
        F.struct(
            F.lit(k).alias("block"),
            F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << (end - at)) - 1)).alias("part"),
        ) for k, (at, end) in enumerate(zip(cuts, cuts[1:]))
    ])
    shards = (
        values.select("fingerprint", F.explode(tree.visited(value, reach)).alias("leaf"))
        .select("fingerprint", "leaf", F.explode(blocks).alias("b")).select("fingerprint", "leaf", "b.*")
        .repartition("leaf", "block", "part").sortWithinPartitions("leaf", "block", "part", "fingerprint")
    )
    return shards.mapInPandas(lambda batches: _links(batches, reach), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 4, reach: int = 4,
    depth: int = 2,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, one row for each row of ``docs``.

    ``component_id`` is the least id reachable over links of at most ``reach`` differing bits, itself included. Texts
    without words (null, empty) have fingerprint 0 and link like any other. Equal texts share a fingerprint, which
    takes part in the search once however many rows hold it. Repeated rows are repeated; a null id stays null and is
    no component's least id unless all ids of its component are null. An empty table gives no rows.
    """
    prints = stage(
        docs.select(F.col(id_column).alias("doc_id"), fingerprint(F.col(text_column), width).alias("fingerprint")),
        "fingerprints",
    )
    values = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    members = values.join(
        connected(hamming_links(prints, reach, depth)).withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    least = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = members.join(least, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
