"""Merkle manifest of a dataset: a tree for each source and one over their roots, stored in van Emde Boas order.

A node has up to 16 children. Aligned subtrees of a few levels are blocks, one row each: their digests lie in an array
that is cut at half the height, the upper part first and then the lower subtrees from left to right, each laid out the
same way. Addresses follow from level and index alone, so a run of siblings is found without pointers. The roots of
blocks are the leaves of the next tier of blocks, until one is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgrid.operators.places import numbered
from pressgrid.sources.staging import stage

FAN = 16
#: Levels of a block, its root included: 4,096 nodes at the bottom.
LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_NODES = "tree string, position long, size long, digest string, doc_id long, other string"
_BLOCKS = (
    "tree string, block long, size long, levels int, nodes binary, root string, doc_ids array<long>, others array<string>"
)
_PATHS = "tree string, position long, above binary"
_AUDIT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def count_nodes(levels: int) -> int:
    """Nodes of a complete tree."""
    return (FAN**levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index):
    """Place of node ``index`` (from the left) at ``depth`` (the root at 0) in the layout of a tree of ``levels``."""
    if levels == 1:
        return index * 0
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, index)
    lower, below = levels - upper, depth - upper
    which, inside = index // FAN**below, index % FAN**below
    return count_nodes(upper) + which * count_nodes(lower) + address(lower, below, inside)


def levels_for(size: int, most: int) -> int:
    """Levels of the block of a tree that has ``size`` nodes at the bottom: all where it goes on above the block."""
    levels = 1
    while levels < most and FAN ** (levels - 1) < size:
        levels += 1
    return levels


class Block:
    """The digests of an aligned subtree, as 64 hex digits each, in van Emde Boas order."""

    def __init__(self, levels: int, count: int, nodes: np.ndarray):
        self.levels, self.nodes = levels, nodes
        self.counts = [-(-count // FAN ** (levels - 1 - depth)) for depth in range(levels)]

    @classmethod
    def grow(cls, leaves: Sequence[bytes], levels: int) -> Block:
        """Build from the bottom; every run of 16, the last one maybe shorter, makes a node."""
        block = cls(levels, len(leaves), np.zeros(count_nodes(levels), dtype="S64"))
        row = np.array(leaves, dtype="S64")
        for depth in range(levels - 1, -1, -1):
            block.nodes[address(levels, depth, np.arange(len(row)))] = row
            if depth:
                data = row.tobytes()
                row = np.array([digest(data[at : at + 64 * FAN]) for at in range(0, len(data), 64 * FAN)], dtype="S64")
        return block

    @classmethod
    def read(cls, levels: int, count: int, data: bytes) -> Block:
        return cls(levels, count, np.frombuffer(data, dtype="S64"))

    def write(self) -> bytes:
        """The array up to its last node in use."""
        used = 1 + max(int(address(self.levels, d, np.int64(c - 1))) for d, c in enumerate(self.counts))
        return self.nodes[:used].tobytes()

    @property
    def root(self) -> bytes:
        return bytes(self.nodes[0])

    def run(self, depth: int, index: int) -> bytes:
        """The digests of the run of siblings that node ``index`` belongs to, itself included."""
        first = index - index % FAN
        places = address(self.levels, depth, np.arange(first, min(first + FAN, self.counts[depth])))
        return self.nodes[places].tobytes()

    def path(self, depth: int, index: int) -> list[tuple[bytes, bytes]]:
        """Siblings on the left and on the right, level by level, from ``depth`` up to below the root."""
        steps = []
        while depth:
            run, at = self.run(depth, index), 64 * (index % FAN)
            steps.append((run[:at], run[at + 64 :]))
            depth, index = depth - 1, index // FAN
        return steps


def packed(path: list[tuple[bytes, bytes]]) -> bytes:
    """A path as bytes: for each level two counts and the digests."""
    return b"".join(bytes([len(left) // 64, len(right) // 64]) + left + right for left, right in path)


def unpacked(data: bytes) -> list[tuple[bytes, bytes]]:
    path, at = [], 0
    while at < len(data):
        middle = at + 2 + 64 * data[at]
        end = middle + 64 * data[at + 1]
        path.append((data[at + 2 : middle], data[middle:end]))
        at = end
    return path


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf leads to."""
    return reduce(lambda now, step: digest(step[0] + now + step[1]), path, leaf)


# --- tasks on one block -------------------------------------------------------------------------


def _grow(key: tuple, rows: pd.DataFrame, most: int) -> pd.DataFrame:
    rows = rows.sort_values("position")
    size = int(rows["size"].iloc[0])
    levels = levels_for(size, most)
    block = Block.grow([x.encode() for x in rows["digest"]], levels)
    return pd.DataFrame([{
        "tree": key[0], "block": key[1], "size": size, "levels": levels, "nodes": block.write(),
        "root": block.root.decode(), "doc_ids": list(rows["doc_id"].array), "others": list(rows["other"]),
    }])


def _open(row: pd.Series) -> Block:
    return Block.read(int(row["levels"]), len(row["doc_ids"]), row["nodes"])


def _paths(key: tuple, rows: pd.DataFrame, most: int) -> pd.DataFrame:
    row = rows.iloc[0]
    block, above = _open(row), row["above"]
    count, bottom = block.counts[-1], block.levels - 1
    return pd.DataFrame({
        "tree": key[0], "position": key[1] * FAN ** (most - 1) + np.arange(count),
        "above": [packed(block.path(bottom, at)) + above for at in range(count)],
    })


def _audit(key: tuple, rows: pd.DataFrame, root: str) -> pd.DataFrame:
    row = rows.iloc[0]
    block, above = _open(row), unpacked(row["above"])
    bottom, found = block.levels - 1, []
    for first in range(0, block.counts[-1], FAN):
        run = block.run(bottom, first) if bottom else block.root
        # Siblings above the run are the same for all its leaves.
        higher = (block.path(bottom - 1, first // FAN) if bottom else []) + above
        tail = b"".join(left + right for left, right in higher)
        for at in range(0, len(run), 64):
            leaf, left, right = run[at : at + 64], run[:at], run[at + 64 :]
            other = row["others"][first + at // 64]
            own = leaf if other is None else other.encode()
            folded = fold(digest(left + own + right) if bottom else own, higher).decode()
            found.append((leaf.decode(), digest(left + right + tail).decode(), folded))
    leaves, proofs, folds = zip(*found, strict=True)
    ids = pd.array([None if pd.isna(x) else int(x) for x in row["doc_ids"]], dtype="Int64")
    return pd.DataFrame({
        "doc_id": ids, "leaf": leaves, "subroot": row["subroot"], "root": root, "proof_sha256": proofs,
        "folded_root": folds, "verified": [x == root for x in folds],
    })


# --- the manifest -------------------------------------------------------------------------------


@dataclass
class Manifest:
    """``root`` of all sources (null without rows), block tables of the sources' trees tier by tier, those of the tree
    over them, and ``subroots`` (tree, root, position). All tables are written to the shared folder."""

    root: str | None
    tiers: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    levels: int


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 over the values of a row: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(part, values)), 256)


def _forest(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Block tables, tier by tier, of all trees at once."""
    span, tiers = FAN ** (levels - 1), []
    while True:
        placed = nodes.withColumn("block", (F.col("position") / span).cast("long"))
        tiers.append(stage(placed.groupBy("tree", "block").applyInPandas(lambda key, rows: _grow(key, rows, levels), _BLOCKS), "blocks"))
        going = tiers[-1].filter(F.col("size") > span)
        if going.isEmpty():
            return tiers
        nodes = going.select(
            "tree", F.col("block").alias("position"), F.ceil(F.col("size") / span).cast("long").alias("size"),
            F.col("root").alias("digest"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("other"),
        )


def _ends(tiers: list[DataFrame], levels: int) -> DataFrame:
    """The last block of each tree."""
    return reduce(DataFrame.unionAll, (blocks.filter(F.col("size") <= FAN ** (levels - 1)) for blocks in tiers))


def _descend(tiers: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """``above`` (tree, above) of whole trees carried down to the lowest blocks: (tree, block, above)."""
    going = None
    for blocks in reversed(tiers):
        ends = blocks.filter(F.col("size") <= FAN ** (levels - 1)).join(above, "tree").select("tree", "block", "above")
        reached = ends if going is None else ends.unionByName(going.withColumnRenamed("position", "block"))
        if blocks is tiers[0]:
            return reached
        opened = blocks.join(reached, ["tree", "block"]).groupBy("tree", "block")
        going = opened.applyInPandas(lambda key, rows: _paths(key, rows, levels), _PATHS)
    raise AssertionError


def build_manifest(
    docs: DataFrame, columns: Sequence[str] = COLUMNS, tree: str = "source", id_column: str = "doc_id",
    other: Column | None = None, levels: int = LEVELS,
) -> Manifest:
    """The manifest of ``docs``: a leaf a row over ``columns``, a tree for each value of ``tree`` in order of ids.

    ``other`` may give, for rows to be checked against the manifest, the leaf of another version of the row; it is kept
    beside the tree and takes no part in it. Leaves are numbered by a range-partitioned sort, so a source with most rows
    lies over many tasks; a task holds one block of 16 ** (``levels`` - 1) leaves. Null sources make a tree of their own,
    which comes first; null ids come first in their tree; rows with the same id are ordered by their digests. Repeated rows are
    leaves of their own. Columns beyond ``columns`` do not count. An empty table has no root.
    """
    spark = docs.sparkSession
    own = stage(docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col(tree).cast("string")), F.lit("")).alias("tree"),
        F.col(id_column).cast("long").alias("doc_id"), leaf_digest([F.col(c) for c in columns]).alias("digest"),
        (F.lit(None) if other is None else other).cast("string").alias("other"),
        F.monotonically_increasing_id().alias("row"),  # repeated rows are spread by it
    ), "leaves")
    keep = partial(stage, name="places")
    nodes = numbered(own, [F.asc("doc_id"), F.asc("digest"), F.asc("row")], keep, ["tree"], "position", "size").drop("row")
    tiers = _forest(nodes, levels)
    subroots = stage(numbered(
        _ends(tiers, levels).select("tree", "root"), [F.asc("tree")], keep, (), "position", "size"
    ), "subroots")
    top = _forest(subroots.select(
        F.lit("").alias("tree"), "position", "size", F.col("root").alias("digest"),
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("other"),
    ), levels)
    last = _ends(top, levels).select("root").first()
    return Manifest(last and last[0], tiers, top, subroots.drop("size"), levels)


def audit(manifest: Manifest) -> DataFrame:
    """Each leaf with its proof checked: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of all siblings
    up to the root, left to right), ``folded_root`` (from the row's other version where there is one) and ``verified``.

    Siblings are read from the blocks by address; what lies above a block is sent to it once, whatever the number of its leaves.
    """
    levels, subroots = manifest.levels, manifest.subroots
    nothing = F.lit(b"").alias("above")
    lowest = _descend(manifest.top, _ends(manifest.top, levels).select("tree", nothing), levels)
    blocks = manifest.top[0].join(lowest, ["tree", "block"]).groupBy("tree", "block")
    over = blocks.applyInPandas(lambda key, rows: _paths(key, rows, levels), _PATHS).select("position", "above")
    placed = stage(subroots.join(over, "position").select("tree", F.col("root").alias("subroot"), "above"), "above")
    reached = _descend(manifest.tiers, placed.select("tree", "above"), levels)
    opened = manifest.tiers[0].drop("root").join(reached, ["tree", "block"]).join(placed.select("tree", "subroot"), "tree")
    root = manifest.root
    return opened.groupBy("tree", "block").applyInPandas(lambda key, rows: _audit(key, rows, root), _AUDIT)


def lowered(text: Column) -> Column:
    """``text`` with A-Z lower-cased."""
    return F.translate(text, UPPER, LOWER)


def tampered_audit(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The audit of ``docs`` in which the text of every row whose crc32(doc_id as text) is divisible by 5 is lower-cased
    (A-Z) after the manifest was made. Rows without an id are left as they are."""
    values = [lowered(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS]
    chosen = F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0
    return audit(build_manifest(docs, other=F.when(chosen, leaf_digest(values)), levels=levels))
