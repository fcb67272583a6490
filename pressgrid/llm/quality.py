"""Quality selection by importance resampling with hashed n-gram models and Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgrid.sources.staging import stage

BUCKETS = 1 << 16
#: Bytes of an n-gram.
GRAM = 4
SEED = 11
#: Labelled texts that the threshold, and the target model, are fitted on at most.
LABELLED_ROWS = 20_000
#: Added to each bucket, as a share of the even distribution's mass per bucket.
SMOOTHING = 1.0
#: N-grams that every text counts as in the draw.
LENGTH = 100.0
#: Bytes of a text counted at a time.
PIECE = 1 << 20


def _buckets(data: np.ndarray) -> np.ndarray:
    """Hashed byte n-grams, by multiplication of the packed bytes."""
    count = len(data) - GRAM + 1
    packed = np.zeros(max(count, 0), dtype=np.uint64)
    for at in range(GRAM):
        packed = packed * np.uint64(256) + data[at : at + max(count, 0)]
    return ((packed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def _pieces(text: bytes) -> Iterator[np.ndarray]:
    data = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, max(len(data) - GRAM + 1, 0), PIECE):
        yield _buckets(data[at : at + PIECE + GRAM - 1])


def _repeats(text: bytes) -> tuple[int, int]:
    """Word pairs that repeat a word, and those that do not: the word bigrams in two buckets."""
    words = text.split()
    same = sum(map(eq, words, words[1:]))
    return same, max(len(words) - 1, 0) - same


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-gram counts of a task in each class of text: rows (class, bucket, count)."""
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for kind, text in zip(batch["kind"], batch["text"]):
            own = counts.setdefault(int(kind), np.zeros(BUCKETS + 2, dtype=np.int64))
            data = (text or "").encode("utf-8", "surrogatepass")
            for part in _pieces(data):
                own[:BUCKETS] += np.bincount(part, minlength=BUCKETS)
            own[BUCKETS:] += _repeats(data)
    for kind, own in counts.items():
        used = np.flatnonzero(own)
        yield pd.DataFrame({"kind": kind, "bucket": used, "n": own[used]})


@dataclass(frozen=True)
class Ratio:
    """Log ratios of the target's to the raw text's probabilities: of byte n-grams, and of repeated word pairs."""

    grams: np.ndarray
    pairs: np.ndarray
    threshold: float = 0.0

    def of(self, text: str | None) -> float:
        """Mean log ratio of the n-grams plus that of the word pairs; 0 for a text too short for either."""
        data = (text or "").encode("utf-8", "surrogatepass")
        total = sum(float(self.grams[part].sum()) for part in _pieces(data))
        same, other = _repeats(data)
        grams = max(len(data) - GRAM + 1, 0)
        score = total / grams if grams else 0.0
        return score + float(self.pairs @ (same, other)) / (same + other) if same + other else score


def _log_shares(counts: np.ndarray) -> np.ndarray:
    filled = counts + SMOOTHING
    return np.log(filled / filled.sum())


def _model(counts: DataFrame) -> Ratio:
    """From rows (kind, bucket, n): at most two rows for each bucket, so the driver holds a fixed number."""
    table = np.zeros((2, BUCKETS + 2))
    for row in counts.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        table[row["kind"], row["bucket"]] = row["n"]
    raw, target = table
    return Ratio(
        _log_shares(target[:BUCKETS]) - _log_shares(raw[:BUCKETS]), _log_shares(target[BUCKETS:]) - _log_shares(raw[BUCKETS:])
    )


def _threshold(scores: np.ndarray, good: np.ndarray) -> float:
    """The cut between labelled classes with the least mean of the two error rates, halfway between its neighbours."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    ordered, kinds = scores[order], good[order]
    lost = np.concatenate([[0], np.cumsum(kinds)]) / kinds.sum()
    passed = 1 - np.concatenate([[0], np.cumsum(~kinds)]) / (~kinds).sum()
    ends = np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])  # equal scores stay together
    best = int(np.argmin(np.where(ends, lost + passed, np.inf)))
    edges = np.concatenate([[ordered[0] - 1], ordered, [ordered[-1] + 1]])
    return float((edges[best] + edges[best + 1]) / 2)


def _score(rows: DataFrame, model: Ratio) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast((model.grams.astype(np.float32), model.pairs))  # fixed size

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        ratio = Ratio(*held.value)
        return pd.Series([ratio.of(x) for x in texts], dtype="float64")

    return rows.withColumn("log_weight", score("text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> DataFrame:
    """``text`` and ``quality`` of at most about ``most`` labelled ids, taken by a hash of the id.

    An id labelled twice counts as bad if either says so; rows repeated under an id count once.
    """
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, most / max(known.count(), 1))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates()
    return rows.select("text", F.col("quality").cast("int").alias("quality"))


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> Ratio:
    """The ratio of the target's model (labelled good texts, a bounded sample) to the raw text's (all documents).

    The threshold on the log weight is set on the same sample. Without labels of both kinds every text passes.
    """
    sample = stage(labelled_sample(docs, labels, most), "labelled")
    raw = docs.select(F.lit(0).alias("kind"), "text")
    target = sample.filter("quality = 1").select(F.lit(1).alias("kind"), "text")
    model = _model(raw.unionByName(target).mapInPandas(_counted, "kind int, bucket int, n long"))
    scored = _score(sample, model).select("log_weight", "quality").toPandas()  # bounded by ``most``
    if not len(scored):
        return Ratio(model.grams, model.pairs, -np.inf)
    return Ratio(model.grams, model.pairs, _threshold(scored["log_weight"].to_numpy(), scored["quality"].to_numpy() == 1))


def kth_largest(values: DataFrame, k: int) -> float | None:
    """The ``k``-th largest of a column of finite doubles, exactly; null if there are fewer, or for ``k`` < 1.

    Histograms of a fixed number of bins narrow the range until it holds one value, or few; rows are never sorted.
    """
    name = values.columns[0]
    rows = values.select(F.col(name).alias("v")).filter("v is not null")
    if k < 1:
        return None
    while True:
        low, high, count = rows.agg(F.min("v"), F.max("v"), F.count("v")).first()
        if count < k:
            return None
        if low == high:
            return low
        if count <= 10_000:
            return sorted((r[0] for r in rows.collect()), reverse=True)[k - 1]
        width = (high - low) / 1024
        place = F.least(F.floor((F.col("v") - low) / width), F.lit(1023))
        bins = {r["bin"]: r["n"] for r in rows.groupBy(place.alias("bin")).agg(F.count("v").alias("n")).collect()}
        for bin_ in sorted(bins, reverse=True):
            if bins[bin_] >= k:
                rows = rows.filter(place == bin_)
                if bins[bin_] == count:  # one bin holds all: the range is down to neighbouring doubles
                    return sorted({r[0] for r in rows.distinct().collect()}, reverse=True)[0]
                break
            k -= bins[bin_]


def resample(
    docs: DataFrame, model: Ratio, k: int | None = None, length: float = LENGTH, seed: int = SEED,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``log_weight``, ``gumbel_key`` and ``kept`` for each row of ``docs``.

    Importance resampling without replacement by Gumbel top-k. A document's weight is the likelihood of its n-grams under
    the target's model over that under the raw text's, taken for ``length`` n-grams of its kind whatever its own length:
    sums over whole texts would sink long documents that were never labelled, as the raw model has seen their n-grams and
    the target's has not. The key is the logarithm of that weight plus Gumbel noise, which depends on id and ``seed``
    alone. The ``k`` largest keys stay; without ``k`` as many as there are documents at or over the model's threshold.
    Keys that tie with the last are all kept. Null and empty texts have log weight 0 and compete like others; very long
    texts are counted whole; repeated rows share their key and their fate; an empty table gives no rows, and other columns
    are not read.
    """
    rows = _score(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), model)
    even = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    keyed = stage(rows.select(
        "doc_id", "log_weight", (F.col("log_weight") * length - F.log(-F.log(even))).alias("gumbel_key")
    ), "keys")
    if k is None:
        k = keyed.filter(F.col("log_weight") >= float(model.threshold)).count()
    last = kth_largest(keyed.select("gumbel_key"), k)
    kept = F.lit(0 < keyed.count() <= k) if last is None else F.col("gumbel_key") >= last
    return keyed.withColumn("kept", kept)
