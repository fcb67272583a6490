"""Removal of long passages that occur earlier, found through difference-cover anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 20
#: Perfect difference sets (fixed values): any two residues differ by a shift that takes both into the set.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Words that an anchor must span to be worth sending.
LEAST_ANCHOR = 6

PART = 32


def cover_for(window: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and words of an anchor: in any two equal windows some equal anchor lies at one shift in both."""
    period = max((p for p in COVERS if window - p + 1 >= LEAST_ANCHOR), default=1)
    return period, COVERS[period], window - period + 1


class _Words:
    """The words of a text and where they lie in the text joined by single spaces."""

    def __init__(self, text: str | None):
        self.words = (text or "").encode("utf-8", "surrogatepass").split()  # bytes: ASCII white space only
        self.line = b" ".join(self.words)
        lengths = np.fromiter(map(len, self.words), dtype=np.int64, count=len(self.words))
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths

    def hashes(self, places: np.ndarray, words: int) -> np.ndarray:
        """128-bit hashes of the ``words`` words from each place, as rows of two numbers."""
        cuts = zip(self.starts[places].tolist(), self.ends[places + words - 1].tolist())
        line, digest = self.line, xxhash.xxh3_128_digest
        return np.frombuffer(b"".join([digest(line[a:b]) for a, b in cuts]), dtype="<i8").reshape(-1, 2)


#: Anchors are found by 64 bits, as a false find costs one window; windows are told apart by 96. The
#: place of a window has the part of its text, a hash that tells texts of one id apart, in its upper half.
ANCHOR_ROWS = "h1 long, place long, __order long, known binary"
WINDOW_ROWS = "h1 long, h2 int, place long, __order long, known binary"


def _shipped(documents: list, found: list[tuple[np.ndarray, np.ndarray]], earliest: bool) -> pd.DataFrame:
    """Rows of ``WINDOW_ROWS`` (or ``ANCHOR_ROWS``) for the hashes of one batch, each hash sent once.

    ``documents`` holds (order, part) and ``found`` the places and hashes of each. A hash that the batch repeats is sent
    with its first place; its other places (or, unless ``earliest``, all of them) are settled here and go as one ``known``
    row for each document. So a passage shared by many documents takes one row a batch.
    """
    owner = np.repeat(np.arange(len(found)), [len(places) for places, _ in found])
    places = np.concatenate([places for places, _ in found])
    hashes = np.concatenate([values for _, values in found])
    order = np.array([d[0] for d in documents], dtype=np.int64)
    part = np.array([d[1] for d in documents], dtype=np.int64) << PART if earliest else np.zeros_like(order)
    full = part[owner] | places
    at = np.lexsort((full, order[owner], hashes[:, 1], hashes[:, 0]))
    owner, places, hashes, full = owner[at], places[at], hashes[at], full[at]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]).any(axis=1)
    group = np.cumsum(first) - 1
    head = np.flatnonzero(first)[group]
    if earliest:  # strictly later than the first place: repeated rows of one document are not
        settled = (order[owner] != order[owner[head]]) | (full != full[head])
    else:
        settled = np.bincount(group)[group] > 1
    sent = pd.DataFrame({
        "h1": hashes[first, 0], "h2": (hashes[first, 1] >> PART).astype("int32"), "place": full[first],
        "__order": order[owner[first]],
    })
    sent["known"] = None
    known = []
    if settled.any():
        by = np.argsort(owner[settled], kind="stable")
        whose, where = owner[settled][by], places[settled][by].astype("<i4")
        cuts = np.flatnonzero(whose[1:] != whose[:-1]) + 1
        for own, doc in zip(np.split(where, cuts), whose[[0, *cuts]]):
            known.append((hash(documents[doc]), 0, part[doc], order[doc], own.tobytes()))  # spread over tasks
    if known:
        sent = pd.concat([sent, pd.DataFrame(known, columns=list(sent.columns))], ignore_index=True)
    return sent if earliest else sent.drop(columns="h2")


def _flush(documents: list, found: list, earliest: bool) -> Iterator[pd.DataFrame]:
    if found:
        yield _shipped(documents, found, earliest)
    documents.clear()
    found.clear()


def _anchors(batches: Iterator[pd.DataFrame], window: int, most: int) -> Iterator[pd.DataFrame]:
    period, cover, span = cover_for(window)
    documents, found, held = [], [], 0
    for batch in batches:
        for order, own, text in zip(batch["__order"], batch["__part"], batch["__text"]):
            words = _Words(text)
            if len(words.words) < window:
                continue
            places = np.arange(len(words.words) - span + 1)
            places = places[np.isin(places % period, cover)]
            documents.append((order, own))
            found.append((places, words.hashes(places, span)))
            held += len(places)
            if held >= most:
                yield from _flush(documents, found, earliest=False)
                held = 0
    yield from _flush(documents, found, earliest=False)


def _windows(batches: Iterator[pd.DataFrame], window: int, most: int) -> Iterator[pd.DataFrame]:
    """Hashes of the whole windows around anchors that occur more than once."""
    period, _, _ = cover_for(window)
    documents, found, held = [], [], 0
    for batch in batches:
        for order, own, text, places, known in zip(
            *(batch[x] for x in ("__order", "__part", "__text", "__places", "__known"))
        ):
            words = _Words(text)
            last = len(words.words) - window
            anchors = _places(places, known, None)
            change = np.zeros(last + 2, dtype=np.int64)
            np.add.at(change, np.clip(anchors - (period - 1), 0, last + 1), 1)
            np.add.at(change, np.clip(anchors + 1, 0, last + 1), -1)
            starts = np.flatnonzero(np.cumsum(change[:-1]) > 0)
            documents.append((order, own))
            found.append((starts, words.hashes(starts, window)))
            held += len(starts)
            if held >= most:
                yield from _flush(documents, found, earliest=True)
                held = 0
    yield from _flush(documents, found, earliest=True)


def _places(places, known, part: int | None) -> np.ndarray:
    """Places of a document's rows, single and packed; with ``part`` those of that text alone."""
    single = np.asarray(places if places is not None else [], dtype=np.int64)
    packed = known if known is not None else []
    if part is not None:
        single = single[single >> PART == part] & 0xFFFFFFFF
        packed = [x for x in packed if x["place"] >> PART == part]
    return np.concatenate([single, *(np.frombuffer(x["known"], dtype="<i4").astype(np.int64) for x in packed)])


def _kept(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, part, copies, places, known in zip(
            *(batch[x] for x in ("__text", "__part", "__copies", "__places", "__known"))
        ):
            words = _Words(text)
            count = len(words.words)
            gone = np.zeros(count, dtype=bool)
            if copies is not None and part in copies:
                gone[:] = count >= window
            elif len(marks := _places(places, known, part)):
                change = np.zeros(count + 1, dtype=np.int64)
                np.add.at(change, marks, 1)
                np.add.at(change, marks + window, -1)
                gone = np.cumsum(change[:-1]) > 0
            removed = int(gone.sum())
            kept = b" ".join([word for word, out in zip(words.words, gone) if not out]) if removed else words.line
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            rows.append((
                count, removed, kept.decode("utf-8", "surrogatepass"), hashlib.sha256(kept).hexdigest(),
                [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)],
            ))
        out = batch.drop(columns=["__text", "__copies", "__places", "__known", "__order", "__part"]).reset_index(drop=True)
        names = ["n_words", "n_removed", "kept_text", "kept_sha256", "removed"]
        yield pd.concat([out, pd.DataFrame(rows, columns=names, dtype=object)], axis=1)


def _gathered(rows: DataFrame) -> DataFrame:
    packed = F.col("known").isNotNull()
    return rows.groupBy("__order").agg(
        F.collect_list(F.when(~packed, F.col("place"))).alias("__places"),
        F.collect_list(F.when(packed, F.struct("place", "known"))).alias("__known"),
    )


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW,
    batch_hashes: int = 2_000_000,
) -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``n_removed``, ``kept_text``, ``kept_sha256``, ``removed`` (word spans).

    Every word is removed that lies in a window of ``window`` words whose sequence also starts earlier: in a document of
    smaller id, or further ahead in the same. Windows are judged on the input. Kept words are joined by one space.

    A text equal to that of a smaller id repeats all of it, so such copies are settled by a digest and skip the rest. In
    the others only windows at cover positions modulo a period are hashed; two equal windows of full length always share
    one such anchor. Anchors that occur twice are extended: the whole windows around them are hashed and the earliest
    place of each is found. Texts are shuffled once, by id, and that exchange serves all three steps. A passage
    shared by very many documents is reduced to one row for each batch of a task before it is sent.

    Words are runs without ASCII white space. Null and empty texts have no words. Rows without an id have no place in the
    order: they keep all their words and take none from others. Rows that repeat id and text are judged alike, none of
    them earlier than the other; different texts of one id are told apart, and
    ordered, by 32 bits of a hash. Columns of ``docs`` with the names of
    results are replaced. An empty table gives no rows.
    """
    added = ("n_words", "n_removed", "kept_text", "kept_sha256", "removed")
    kept = [x for x in docs.columns if x != text_column and x not in added]
    order, part = F.col(id_column).cast("long"), F.shiftright(F.xxhash64(text_column), 32).cast("int")
    own = docs.withColumns({"__order": order, "__part": part})
    texts = own.filter(order.isNotNull()).select(*kept, F.col(text_column).alias("__text"), "__order", "__part")
    digests = own.filter(order.isNotNull() & F.col(text_column).isNotNull()).select(
        "__order", "__part", F.md5(text_column).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("__order").alias("first"))
    copies = digests.join(first, "digest").filter("__order > first").groupBy("__order").agg(
        F.collect_set("__part").alias("__copies"))
    settled = F.col("known").isNotNull()

    flagged = texts.join(copies, "__order", "left")  # alike in each step: one exchange of texts
    fresh = flagged.filter(F.col("__copies").isNull() | ~F.array_contains("__copies", F.col("__part")))
    anchors = fresh.mapInPandas(lambda b: _anchors(b, window, batch_hashes), ANCHOR_ROWS)
    alike = Window.partitionBy(settled, "h1")
    shared = anchors.withColumn("n", F.count(F.lit(1)).over(alike)).filter((F.col("n") > 1) | settled)
    windows = texts.join(_gathered(shared), "__order").mapInPandas(
        lambda b: _windows(b, window, batch_hashes), WINDOW_ROWS)
    rank = F.rank().over(Window.partitionBy(settled, "h1", "h2").orderBy("__order", "place"))
    later = windows.withColumn("n", rank).filter((F.col("n") > 1) | settled)
    marked = flagged.join(_gathered(later), "__order", "left")
    nameless = own.filter(order.isNull()).select(*kept, F.col(text_column).alias("__text"), "__order", "__part")
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([
        *(f"`{x}` {types[x]}" for x in kept), "n_words long", "n_removed long", "kept_text string", "kept_sha256 string",
        "removed array<struct<start:int,end:int>>",
    ])
    return marked.unionByName(nameless, allowMissingColumns=True).mapInPandas(lambda b: _kept(b, window), schema)
