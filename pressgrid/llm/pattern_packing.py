"""Pattern packing: repeat counts of few-document length patterns are fitted to the length histogram by non-negative
least squares, rounded, and what is left is packed by best fit on counts."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise
from string import punctuation

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressgrid.sources.staging import stage

CAPACITY = 1024
END_ID = 2
#: Capacity up to which patterns of three documents are enumerated besides those of two.
TRIPLES_UP_TO = 4096
#: Steps of the fit.
STEPS = 400
#: Words whose ids a worker remembers (later ones are encoded again), and words of texts that are encoded together.
CACHE_WORDS, GROUP_WORDS = 1_200_000, 100_000

#: A space that does not lead into a word: it stays with what comes before it.
_LOOSE = re.compile(r" (?:\s|\Z)")
_LOOSE_ASCII = tuple(f" {c}" for c in " \t\n\v\f\r\x1c\x1d\x1e\x1f")
#: Line ends that the pre-tokenizer would take together with other white space.
_BLOCKED = re.compile(r"[^\S\n]\n|\n[^\S\n ]|\n\n(?:\s|\Z)|\n (?:\s|\Z)")


def _loose(text: str) -> bool:
    if text.isascii():
        return text.endswith(" ") or any(pair in text for pair in _LOOSE_ASCII)
    return bool(_LOOSE.search(text))


class SpaceEncoder:
    """Ids of a text, put together from those of its words, which are remembered with the space before them.

    For byte-level vocabularies whose pre-tokenizer begins a new unit at every space that a word follows. ``lead`` is how
    the vocabulary writes that space.
    """

    def __init__(self, path: str, remember: int = CACHE_WORDS, lead: str = "Ġ"):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.remember, self.tokenizer = remember, Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.leads = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.leads[[at for token, at in vocabulary.items() if token.startswith(lead)]] = True
        self.line_end = vocabulary["Ċ"]
        self.tails: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def words(text: str) -> list[str]:
        """What stands between spaces that lead into a word; the first entry has no space before it.

        The first word of a further line begins with its line end instead of a space.
        """
        if "\n" in text and not _BLOCKED.search(text) and not _loose(text):
            first, *lines = text.split("\n")
            words = first.split(" ")
            for line in lines:
                parts = line.split(" ")
                parts[0] = "\n" + parts[0]
                words += parts
            return words
        parts = text.split(" ")
        if not _loose(text):
            return parts
        words = parts[:1]
        for part in parts[1:]:
            if part and not part[0].isspace():
                words.append(part)
            else:
                words[-1] += " " + part
        return words

    def _learned(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words; letters with signs behind them are put together from both, as those are units of their own."""
        parted = {}
        for word in words:
            letters = word.rstrip(punctuation)
            if len(letters) < len(word) and letters.lstrip("\n").isalpha():
                parted[word] = letters
        words = words.difference(parted)
        found: dict[str, bytes] = {}
        words.update(x for x in parted.values() if x not in self.known)
        spaced = [x for x in words if not x.startswith("\n")]
        found.update(self._encode([x for x in spaced if " " not in x and "<|" not in x], " ", self.leads))
        lines = [x for x in words if len(x) > 1 and len(x.split()) == 1 and x[0] == "\n" and "<|" not in x and not x[1].isspace()]
        found.update(self._encode(lines, "", np.arange(len(self.leads)) == self.line_end))
        rest = [x for x in words if x not in found]
        found.update(zip(rest, (i.tobytes() for i in self._ids([x if x[0] == "\n" else " " + x for x in rest]))))
        for word, letters in parted.items():
            tail = word[len(letters) :]
            if tail not in self.tails:
                self.tails[tail] = self._ids([tail])[0].tobytes()
            found[word] = (found.get(letters) or self.known[letters]) + self.tails[tail]
        return found

    def _encode(self, words: list[str], joint: str, leads: np.ndarray) -> dict[str, bytes]:
        """Encode words in one line and cut it at the tokens that lead into them; none where these do not agree."""
        ids = self._ids([joint + joint.join(words)])[0] if words else np.empty(0, dtype="<u4")
        starts = np.flatnonzero(leads[ids])
        if len(starts) == len(words) and (not words or starts[0] == 0):
            data, cuts = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
            return dict(zip(words, [data[a:b] for a, b in zip(cuts, cuts[1:])]))
        return {}

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        group, size = [], 0
        for text in texts:
            group.append(self.words(text))
            size += len(group[-1])
            if size >= GROUP_WORDS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, group: list[list[str]]) -> Iterator[bytes]:
        heads = [x.tobytes() for x in self._ids([words[0] for words in group])]
        flat = list(chain.from_iterable(words[1:] for words in group))
        ids = list(map(self.known.get, flat))
        missing = [at for at, own in enumerate(ids) if own is None]
        found = self._learned(set(map(flat.__getitem__, missing)))
        for at in missing:
            ids[at] = found[flat[at]]
        if len(self.known) + len(found) <= self.remember:
            self.known.update(found)
        ends = accumulate((len(words) - 1 for words in group), initial=0)
        for head, (a, b) in zip(heads, pairwise(ends), strict=True):
            yield head + b"".join(ids[a:b])


encoder = lru_cache(maxsize=1)(SpaceEncoder)

# --- fitting, on the histogram alone ------------------------------------------------------------


def enumerate_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns of one, two or three of ``lengths`` that fill a sequence exactly: rows of three lengths, 0 for none."""
    there = np.zeros(capacity + 1, dtype=bool)
    there[lengths] = True
    single = np.array([[capacity, 0, 0]])[: int(there[capacity])]
    own = np.flatnonzero(there[:capacity])
    pairs = own[(2 * own >= capacity) & there[capacity - own]]
    rows = [single, np.stack([pairs, capacity - pairs, 0 * pairs], axis=1)]
    if capacity <= TRIPLES_UP_TO:
        for largest in own[3 * own >= capacity]:
            middle = own[(own <= largest) & (2 * own >= capacity - largest) & (own < capacity - largest)]
            middle = middle[there[capacity - largest - middle]]
            rows.append(np.stack([0 * middle + largest, middle, capacity - largest - middle], axis=1))
    return np.concatenate(rows).astype(np.int64)


def fit(patterns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|^2, where A counts the lengths of each pattern.

    Projected gradient steps with momentum; A is never formed, as a pattern has three entries at most.
    """
    size = len(histogram)
    used = patterns > 0

    def lengths_of(x: np.ndarray) -> np.ndarray:
        return np.bincount(patterns.ravel(), weights=np.repeat(x, 3) * used.ravel(), minlength=size)

    def patterns_of(y: np.ndarray) -> np.ndarray:
        return (y[patterns] * used).sum(axis=1)

    probe = np.ones(len(patterns))
    for _ in range(20):
        grown = patterns_of(lengths_of(probe))
        steepest = np.linalg.norm(grown) / np.linalg.norm(probe)
        probe = grown / np.linalg.norm(grown)
    x = ahead = np.zeros(len(patterns))
    pace = 1.0
    for _ in range(steps):
        after = np.maximum(ahead - patterns_of(lengths_of(ahead) - histogram) / (1.05 * steepest), 0.0)
        quicker = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        x, ahead, pace = after, after + (pace - 1) / quicker * (after - x), quicker
    return x


def rounded(patterns: np.ndarray, repeats: np.ndarray, histogram: np.ndarray) -> tuple[list[tuple[dict, int]], np.ndarray]:
    """Repeats rounded to whole numbers as far as the lengths last, most repeated patterns first, and the lengths left."""
    left, plan = histogram.copy(), []
    whole = np.rint(repeats).astype(np.int64)
    for row in np.argsort(-repeats, kind="stable")[: np.count_nonzero(whole)]:
        own = patterns[row][patterns[row] > 0].tolist()
        contents = {x: own.count(x) for x in own}
        count = min(int(whole[row]), *(int(left[x]) // n for x, n in contents.items()))
        if count:
            for x, n in contents.items():
                left[x] -= count * n
            plan.append((contents, count))
    return plan, left


def pack_residuals(left: np.ndarray, capacity: int) -> list[tuple[dict, int]]:
    """Best fit by falling length, on counts: bins with the same contents are one entry with a number of repeats."""
    spaces: list[int] = []  # in order, those that some bins have left
    bins: dict[int, list[tuple[dict, int]]] = {}

    def put(contents: dict, repeats: int, space: int) -> None:
        if space not in bins:
            bins[space] = []
            insort(spaces, space)
        bins[space].append((contents, repeats))

    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                contents, repeats = bins[space].pop()
                if not bins[space]:
                    del bins[space], spaces[at]
            else:
                space, contents, repeats = capacity, {}, count
            each = min(space // length, count)
            filled = min(repeats, count // each)
            if repeats > filled and contents:
                put(contents, repeats - filled, space)
            put({**contents, length: each}, filled, space - each * length)
            count -= filled * each
    return [entry for entries in bins.values() for entry in entries]


def plan_sequences(histogram: np.ndarray, capacity: int) -> tuple[list[tuple[dict, int]], int]:
    """Patterns (how often each length occurs) with their repeats, and how many of the sequences the fit has filled.

    ``histogram[n]`` counts the pieces of n tokens; whatever the corpus, it has ``capacity`` + 1 entries.
    """
    patterns = enumerate_patterns(np.flatnonzero(histogram), capacity)
    plan, left = [], histogram.copy()
    if len(patterns):
        plan, left = rounded(patterns, fit(patterns, histogram.astype(float)), histogram)
    return plan + pack_residuals(left, capacity), sum(n for _, n in plan)


def places(plan: list[tuple[dict, int]]) -> np.ndarray:
    """For every length of every pattern: length, first rank, how many in a sequence, first sequence, first offset.

    Pieces of one length are ranked; a pattern takes a stretch of ranks. Sorted by length and rank.
    """
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for contents, repeats in plan:
        offset = 0
        for length, each in contents.items():
            rows.append((length, ranks.get(length, 0), each, sequence, offset))
            ranks[length] = ranks.get(length, 0) + each * repeats
            offset += each * length
        sequence += repeats
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


# --- over tables --------------------------------------------------------------------------------

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, doc_tokens long, part int, at long"


def piece_lengths(total: int, capacity: int) -> list[int]:
    """A text within the capacity is one piece; a longer one has a shorter piece first if it does not come out even."""
    first = total % capacity
    return ([first] if first else []) + [capacity] * (total // capacity)


def _tokenize(batches: Iterator[pd.DataFrame], path: str, capacity: int, end_id: int, keep_ids: bool) -> Iterator[pd.DataFrame]:
    encode, end = encoder(path), np.array([end_id], dtype="<u4").tobytes()
    part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
    columns = [name.split()[0] for name in _PIECES.split(", ")] + ["ids"]
    for batch in batches:
        rows = []
        for doc_id, own in zip(batch["doc_id"].array, encode([x or "" for x in batch["text"]]), strict=True):
            ids = own + end
            total, start = len(ids) // 4, 0
            for piece, length in enumerate(piece_lengths(total, capacity)):
                held = ids[4 * start : 4 * (start + length)]
                rows.append((doc_id, piece, start, length, zlib.crc32(held), total, part, seen[length], held if keep_ids else None))
                seen[length] += 1
                start += length
        table = pd.DataFrame(rows, columns=columns)
        table["doc_id"] = table["doc_id"].astype("Int64")
        yield table if keep_ids else table.drop(columns="ids")


def _placed(batches: Iterator[pd.DataFrame], plan) -> Iterator[pd.DataFrame]:
    lengths, firsts, each, sequences, offsets = plan.value.T
    starts = {length: np.searchsorted(lengths, length) for length in np.unique(lengths)}
    ends = {length: np.searchsorted(lengths, length, side="right") for length in starts}
    for batch in batches:
        own, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
        entry = np.empty(len(batch), dtype=np.int64)
        for length in np.unique(own):
            here = own == length
            a, b = starts[length], ends[length]
            entry[here] = a + np.searchsorted(firsts[a:b], rank[here], side="right") - 1
        inside = rank - firsts[entry]
        batch["sequence_id"] = sequences[entry] + inside // each[entry]
        batch["offset"] = offsets[entry] + inside % each[entry] * own
        yield batch.drop(columns="rank")


def pack_by_patterns(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID, keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` (little-endian unsigned 32-bit numbers) follows ``doc_tokens`` if asked for. Texts become ids and ``end_id``; those
    longer than ``capacity`` are cut, the first piece being the shorter one. Pieces are written to the shared folder with their
    number among the task's pieces of the same length. Only the histogram of lengths, ``capacity`` numbers whatever the
    size of the corpus, comes to the driver, where patterns of up to three documents that fill a sequence exactly are fitted to
    it (:func:`fit`), rounded, and the rest packed by best fit. Each task then looks its pieces up by length and rank; a
    length that most pieces have is spread over all tasks. The table of patterns that is broadcast is bounded by the capacity: at most
    capacity² / 12 patterns of three, and residual bins whose contents differ.

    Null and empty texts are the end id alone; repeated rows and null ids are packed like others, each row once; an empty table gives
    no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    pieces = stage(rows.mapInPandas(
        lambda batches: _tokenize(batches, tokenizer_path, capacity, end_id, keep_ids),
        _PIECES + (", ids binary" if keep_ids else ""),
    ), "pieces")
    runs = pieces.groupBy("part", "length").agg(F.count("*").alias("rows"))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in runs.groupBy("length").agg(F.sum("rows")).collect():
        histogram[length] = count
    plan = spark.sparkContext.broadcast(places(plan_sequences(histogram, capacity)[0]))
    before = F.sum("rows").over(Window.partitionBy("length").orderBy("part")) - F.col("rows")
    ranked = pieces.join(runs.select("part", "length", before.alias("before")), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if keep_ids else []),
        (F.col("before") + F.col("at")).alias("rank"),
    )
    shape = ", ".join(f"{name} {kind}" for name, kind in ranked.drop("rank").dtypes)
    return ranked.mapInPandas(lambda batches: _placed(batches, plan), f"{shape}, sequence_id bigint, offset bigint")
