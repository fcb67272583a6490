"""Packing of tokenized documents into sequences of fixed capacity, by harmonic classes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 4096
#: Harmonic classes; documents shorter than their reciprocal share the last.
CLASSES = 32
END_ID = 2
#: Words whose ids one task remembers before it starts anew.
CACHE_WORDS = 900_000
#: Words whose texts are encoded together.
GROUP_WORDS = 100_000
#: Sequences that one task may number.
PER_TASK = 1 << 40

#: What the vocabulary's pre-tokenizer takes as one unit (a fixed value of the tokenizer file).
_UNIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _units(chunk: str) -> int:
    """Units of a chunk: one for letters alone, two where a single mark follows them."""
    if chunk.isalpha():
        return 1
    return 2 if chunk[-1] in ".,!?;:" and chunk[:-1].isalpha() else len(_UNIT.findall(chunk))


def _chunks(text: str) -> list[bytes]:
    """What lies between ASCII white space, with A-Z lower-cased as the tokenizer does next.

    Case is kept where that could matter before: with combining marks, which may compose with a small letter only, and
    with the marks of special tokens.
    """
    data = text.encode("utf-8", "surrogatepass")
    return (data if b"\xcc" in data or b"\xcd" in data or b"<|" in data else data.lower()).split()


class WordEncoder:
    """Ids of a text, put together from those of its chunks between white space, which are remembered.

    For a tokenizer that lower-cases, drops white space and never merges across it. ``word_end`` marks the last token of
    a unit.
    """

    def __init__(self, path: str, remember: int = CACHE_WORDS, word_end: str = "</w>"):
        from tokenizers import Tokenizer

        self.remember = remember
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[at for token, at in vocabulary.items() if token.endswith(word_end)]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]

    def _alone(self, chunks: list[bytes]) -> None:
        self.known.update(zip(chunks, (x.tobytes() for x in self._ids([x.decode() for x in chunks]))))

    def _learn(self, chunks: list[bytes]) -> None:
        """Encode new chunks in one line and cut it by their numbers of units; one by one where these do not agree."""
        plain = [x for x in chunks if b"<|" not in x]
        line = b" ".join(plain).decode()
        units = np.cumsum([_units(x) for x in line.split(" ")]) if plain else np.zeros(1, dtype=int)
        ids = self._ids([line])[0]
        ends = np.flatnonzero(self.closes[ids]) + 1
        if plain and len(units) == len(plain) and len(ends) == units[-1] and ends[-1:] == len(ids):
            data, cuts = ids.tobytes(), [0, *(4 * ends[units - 1]).tolist()]
            self.known.update(zip(plain, [data[a:b] for a, b in zip(cuts, cuts[1:])]))
        else:
            self._alone(plain)
        self._alone([x for x in chunks if b"<|" in x])

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        group, size = [], 0
        for text in texts:
            group.append(_chunks(text))
            size += len(group[-1])
            if size >= GROUP_WORDS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, group: list[list[bytes]]) -> Iterator[bytes]:
        wanted = set().union(*group)
        if new := list(wanted.difference(self.known)):
            if len(self.known) + len(new) > self.remember:
                self.known.clear()
                new = list(wanted)
            self._learn(new)
        for chunks in group:
            yield b"".join(map(self.known.__getitem__, chunks))


encoder = lru_cache(maxsize=2)(WordEncoder)


@dataclass(frozen=True)
class Piece:
    """Consecutive ids of a document, ``start`` ids after its first; ``total`` is the document's number of ids."""

    doc_id: object
    start: int
    ids: bytes
    total: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, size: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[: 4 * size], self.total)
        return head, Piece(self.doc_id, self.start + size, self.ids[4 * size :], self.total)


class HarmonicBins:
    """Bins of one worker. A document of more than capacity / (k + 1) and at most capacity / k tokens is of class k.

    A bin of class k takes exactly k documents (the last class all that is shorter, ``classes`` a bin). The space that is
    then left, less than the class's shortest document for all but the last, is filled from documents that wait in other
    classes: whole ones while any fits, then the head of one, whose rest is dealt to its own class. A bin that finds none
    waiting stays short and takes what comes next, so there is never more than one, and never while a document waits.

    ``put`` gives back (piece, sequence, offset) of full bins, each ``capacity`` long; ``close`` those of the rest: full
    sequences, then one that is not, parted by the binary digits of its length so that nothing is padded.
    """

    def __init__(self, capacity: int, first: int, classes: int = CLASSES):
        self.capacity, self.next, self.classes = capacity, first, min(classes, capacity)
        self.waiting: list[list[Piece]] = [[] for _ in range(self.classes + 1)]
        self.short: list[Piece] = []
        self.space = 0

    def _sequence(self, pieces: list[Piece]) -> list[tuple[Piece, int, int]]:
        rows, offset = [], 0
        for piece in pieces:
            rows.append((piece, self.next, offset))
            offset += len(piece)
        self.next += 1
        return rows

    def _filler(self) -> Piece | None:
        """The longest waiting document that surely fits the space, else one of the longest, to be cut."""
        fits = self.capacity // self.space + 1
        for kind in (*range(fits, self.classes + 1), *range(1, min(fits, self.classes + 1))):
            if self.waiting[kind]:
                return self.waiting[kind].pop()
        return None

    def _fill(self) -> list[tuple[Piece, int, int]]:
        """Fill the short bin from waiting documents; gives its rows once it is full."""
        while self.space:
            piece = self._filler()
            if piece is None:
                return []
            if len(piece) > self.space:
                piece, rest = piece.cut(self.space)
                self.waiting[self._class(rest)].append(rest)
            self.short.append(piece)
            self.space -= len(piece)
        full, self.short = self.short, []
        return self._sequence(full)

    def _class(self, piece: Piece) -> int:
        return min(self.capacity // len(piece), self.classes)

    def put(self, piece: Piece) -> list[tuple[Piece, int, int]]:
        rows, size = [], 4 * self.capacity
        whole = len(piece.ids) - len(piece.ids) % size
        for at in range(0, whole, size):
            rows += self._sequence([Piece(piece.doc_id, piece.start + at // 4, piece.ids[at : at + size], piece.total)])
        if whole == len(piece.ids):
            return rows
        piece = piece.cut(whole // 4)[1] if whole else piece
        kind = self._class(piece)
        self.waiting[kind].append(piece)
        if self.space:
            rows += self._fill()
        # A rest that was cut may complete the bin of its own class in turn; it is shorter each time.
        while not self.space and (kind := next((k for k, x in enumerate(self.waiting) if k and len(x) >= k), 0)):
            self.short, self.waiting[kind] = self.waiting[kind][:kind], self.waiting[kind][kind:]
            self.space = self.capacity - sum(map(len, self.short))
            rows += self._fill()
        return rows

    def close(self) -> list[tuple[Piece, int, int]]:
        rows, tail = [], [*self.short, *(x for kind in self.waiting for x in kind)]
        left = sum(map(len, tail))
        sizes = [self.capacity] * (left // self.capacity) + [
            1 << k for k in range(self.capacity.bit_length() - 2, -1, -1) if left % self.capacity >> k & 1
        ]
        tail.reverse()
        for size in sizes:
            own = []
            while size:
                piece = tail.pop()
                if len(piece) > size:
                    piece, rest = piece.cut(size)
                    tail.append(rest)
                own.append(piece)
                size -= len(piece)
            rows += self._sequence(own)
        self.__init__(self.capacity, self.next, self.classes)
        return rows


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset")


def _pack(
    batches: Iterator[pd.DataFrame], path: str, capacity: int, end_id: int, keep_ids: bool, remember: int, release: bool
):
    encode, end = encoder(path, remember), np.array([end_id], dtype="<u4").tobytes()
    bins = HarmonicBins(capacity, TaskContext.get().partitionId() * PER_TASK)

    def frame(rows: list[tuple[Piece, int, int]]) -> pd.DataFrame:
        table = pd.DataFrame([
            (x.doc_id, x.start, len(x), zlib.crc32(x.ids), x.total, x.ids if keep_ids else None, sequence, offset)
            for x, sequence, offset in rows
        ], columns=COLUMNS)
        table["doc_id"] = table["doc_id"].astype("Int64")
        return table if keep_ids else table.drop(columns="ids")

    for batch in batches:
        rows = []
        for doc_id, own_ids in zip(batch["doc_id"].array, encode([x or "" for x in batch["text"]])):
            ids = own_ids + end
            rows += bins.put(Piece(doc_id, 0, ids, len(ids) // 4))
            if len(rows) > 20_000:
                yield frame(rows)
                rows = []
        yield frame(rows)
    yield frame(bins.close())
    if release:
        encoder.cache_clear()


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True,
    remember: int = CACHE_WORDS, release: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` (little-endian unsigned 32-bit numbers) follows if asked for. Documents become ids and ``end_id``; whole
    sequences are cut off the long ones, what is left is dealt to harmonic classes, whose bins take a fixed number of
    documents each, and one more is cut to fill the space that is left. Every sequence is full but the last of a task,
    which is parted into sequences as long as powers of two: nothing is padded. Each task packs its own rows: no shuffle,
    no shared state, memory bounded by one open bin a class and a cache of fixed size. Null and empty texts are the end id
    alone; a very long text is whole sequences and one rest; documents that tie in length wait in the order they came;
    repeated rows and null ids are packed like others, each row once; other columns are not read; an empty table gives no
    rows. ``capacity`` must be a power of two.
    ``remember`` words stay in a worker's memory, about 200 bytes each, also between its tasks; with ``release`` a task
    gives them back when it ends.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long," + (
        " ids binary," if keep_ids else "") + " sequence_id long, offset long"
    return rows.mapInPandas(lambda batches: _pack(batches, tokenizer_path, capacity, end_id, keep_ids, remember, release), schema)
