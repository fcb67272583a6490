"""Ranked lexical search without random access: impact-sorted lists are read in sequence, and every document carries an
interval for its score until the best ones are settled."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressgrid.sources.staging import stage

TOP = 50
#: Distinct query terms that one pass over the documents looks for; more are searched in further passes.
PASS_TERMS = 100_000
#: Entries of a list that are read first; each further read is twice as long.
FIRST_READ = 64
#: Intervals (documents times terms of an item) held at once.
CELLS = 20_000_000

#: What each byte of a text becomes: a letter or digit itself, A-Z in lower case, other ASCII characters a space.
_TERM_BYTES = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in range(256)
)
_POSTINGS = "row long, doc_id long, n long, terms array<int>, tfs array<int>"
_FOUND = "item int, doc_id long, row long, score long"


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return (text or b"").translate(_TERM_BYTES).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term adds to a document's score."""
    m = 50 + (50 * n * documents) // max(length, 1)
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, top: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the documents that may be among the ``top`` best scores of at least ``least``, ties included.

    ``lists`` holds, for each term, documents (numbers below ``documents``) and impacts in falling order. They are read
    from the front only. A document's score lies between what has been read of it and that plus the next impacts of the
    lists in which it has not been met. Reading ends when every document whose upper bound reaches the ``top``-th lower
    bound has an interval of one point, so that members, ties and scores are settled.
    """
    lower = np.zeros(documents, dtype=np.int64)
    met = np.zeros((len(lists), documents), dtype=bool)
    ahead = np.array([own[0] if len(own) else 0 for _, own in lists], dtype=np.float64)
    at, length = 0, FIRST_READ
    while True:
        for number, (docs, own) in enumerate(lists):
            if ahead[number]:
                read = slice(at, at + length)
                lower[docs[read]] += own[read]
                met[number, docs[read]] = True
                ahead[number] = own[at + length] if at + length < len(own) else 0
        at, length = at + length, 2 * length
        open_lists = np.flatnonzero(ahead)
        # Impacts are far below 2^53, so sums of doubles are exact.
        rest = (ahead.sum() - ahead[open_lists] @ met[open_lists]).astype(np.int64)
        bar = max(least, int(np.partition(lower, -top)[-top]) if documents >= top else least)
        possible = lower + rest >= bar
        if not (possible & (rest > 0)).any():
            places = np.flatnonzero(possible)
            return places, lower[places]


# --- tasks --------------------------------------------------------------------------------------


def _read(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    """Texts to the numbers and counts of the query terms in them."""
    known = vocabulary.value
    for batch in batches:
        rows, ids = batch.column("row"), batch.column("doc_id")
        lengths, terms, tfs = [], [], []
        for text in batch.column("text"):
            found = terms_of(text.as_py())
            lengths.append(len(found))
            numbers, counts = np.unique(
                np.fromiter((x for x in map(known.get, found) if x is not None), dtype=np.int32), return_counts=True
            )
            terms.append(numbers)
            tfs.append(counts.astype(np.int32))
        ends = pa.array(np.cumsum([0, *map(len, terms)], dtype=np.int32))
        flat = [np.concatenate([np.empty(0, np.int32), *parts]) for parts in (terms, tfs)]
        yield pa.RecordBatch.from_arrays(
            [rows, ids, pa.array(lengths, pa.int64()), *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in flat)],
            names=["row", "doc_id", "n", "terms", "tfs"],
        )


class Searcher:
    """The best documents of each item over the shards that one task meets."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, documents: int, length: int, top: int):
        self.items, self.weights, self.documents, self.length, self.top = items, weights, documents, length, top
        none = np.empty(0, dtype=np.int64)
        self.best = [(none, none, none) for _ in items]  # scores, ids (nulls last), rows

    def shard(self, rows: np.ndarray, ids: np.ndarray, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        """Add documents whose terms are ``terms[ends[i]:ends[i + 1]]``."""
        owner = np.repeat(np.arange(len(rows)), np.diff(ends))
        own = impacts(self.weights[terms], tfs.astype(np.int64), n[owner], self.documents, self.length)
        order = np.lexsort((-own, terms))
        terms, owner, own = terms[order], owner[order], own[order]
        bounds = np.searchsorted(terms, np.arange(len(self.weights) + 1))
        for item, wanted in enumerate(self.items):
            spans = [(bounds[t], bounds[t + 1]) for t in wanted if bounds[t] < bounds[t + 1] and self.weights[t]]
            if not spans:
                continue
            scores, _, _ = self.best[item]
            least = int(scores[-1]) if len(scores) == self.top else 1
            found, points = nra([(owner[a:b], own[a:b]) for a, b in spans], len(rows), self.top, max(least, 1))
            if len(found):
                self.best[item] = self._merged(item, points, ids[found], rows[found])

    def _merged(self, item: int, *found: np.ndarray) -> tuple[np.ndarray, ...]:
        scores, ids, rows = (np.concatenate(pair) for pair in zip(self.best[item], found, strict=True))
        order = np.lexsort((rows, ids, -scores))[: self.top]
        return scores[order], ids[order], rows[order]


_NO_ID = np.iinfo(np.int64).max


def _search(batches: Iterator[pa.RecordBatch], setting) -> Iterator[pa.RecordBatch]:
    """Impact-sorted lists for each batch of documents, and the best of the task for each item."""
    items, weights, documents, length, top = setting.value
    searcher = Searcher(items, weights, documents, length, top)
    widest = max(map(len, items), default=1)
    step = max(top, CELLS // max(widest, 1))
    for whole in batches:
        for first in range(0, whole.num_rows, step):
            batch = whole.slice(first, step)
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            lists = [batch.column(c) for c in ("terms", "tfs")]
            ends = lists[0].offsets.to_numpy()
            terms, tfs = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
            searcher.shard(
                batch.column("row").to_numpy(zero_copy_only=False), ids,
                batch.column("n").to_numpy(zero_copy_only=False), ends - ends[0], terms, tfs,
            )
    for item, (scores, ids, rows) in enumerate(searcher.best):
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(ids), item, dtype=np.int32)), pa.array(ids, mask=ids == _NO_ID), pa.array(rows), pa.array(scores),
        ], names=["item", "doc_id", "row", "score"])


# --- over tables --------------------------------------------------------------------------------


def passes(items: Iterable[tuple], limit: int = PASS_TERMS) -> Iterator[list[tuple]]:
    """(id, terms) in blocks of at most ``limit`` terms, or of one item."""
    block, size = [], 0
    for item_id, terms in items:
        if block and size + len(terms) > limit:
            yield block
            block, size = [], 0
        block.append((item_id, terms))
        size += len(terms)
    if block:
        yield block


def _one_pass(docs: DataFrame, block: list[tuple], top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {term: number for number, term in enumerate(dict.fromkeys(chain.from_iterable(t for _, t in block)))}
    known = spark.sparkContext.broadcast(vocabulary)  # at most PASS_TERMS terms, or those of one text
    postings = stage(docs.mapInArrow(lambda batches: _read(batches, known), _POSTINGS), "postings")
    documents, length = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([weight(documents, df.get(term, 0)) for term in range(len(vocabulary))], dtype=np.int64)
    items = [np.array([vocabulary[t] for t in terms], dtype=np.int64) for _, terms in block]
    setting = spark.sparkContext.broadcast((items, weights, documents, length, top))
    held = postings.filter(F.size("terms") > 0)
    found = held.mapInArrow(lambda batches: _search(batches, setting), _FOUND)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    names = spark.createDataFrame([(at, name) for at, (name, _) in enumerate(block)], "item int, item_id long")
    return ranked.filter(F.col("rank") <= top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, pass_terms: int = PASS_TERMS, id_column: str = "doc_id",
    text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The ``top`` documents for each item: ``item_id``, ``rank`` from 1, ``doc_id`` and ``score`` above 0.

    One pass over all texts writes the numbers and counts of the query terms to the shared folder; document frequencies
    and lengths come from that table. It is then searched in shards of as many documents as an Arrow batch: a shard's lists
    are sorted by impact and read as :func:`nra` does, the task's best scores so far cutting short what follows. Tasks hand over
    ``top`` rows an item, so nothing else is shuffled, however frequent a term. Items are searched in blocks of ``pass_terms``
    distinct terms, which bounds what is broadcast.

    Equal scores go by ascending id, null ids last, then by the place of the row. Rows with the same id are documents of their
    own. Items that agree in id and text count once; those that agree in the id alone are each ranked. Null and empty texts have no
    terms: such documents do not count, such items have no rows. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    asked = (
        items.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text).alias("text")).distinct()
        .orderBy("item_id", "text")
    )
    listed = ((r.item_id, list(dict.fromkeys(terms_of((r.text or "").encode())))) for r in asked.toLocalIterator())
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").cast("binary").alias("text"),
    )
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in passes(((i, t) for i, t in listed if t), pass_terms):
        found = found.unionAll(_one_pass(texts, block, top))
    return found
