"""Each operator against brute force, and on nulls, empty texts, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import hashlib
import io
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from pressgrid.llm import (
    ann,
    components,
    merkle,
    mixing,
    packing,
    quality,
    simhash,
    substring,
    toxicity,
    url_filter,
    warc,
)
from pressgrid.llm.queries import RULES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, block string, copies string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and white texts, repeated rows, and columns named like internal ones."""
    words = " ".join(f"w{i}" for i in range(45))
    rows = [
        (1, words, "en", "a", 1, "x", "y"), (1, words, "en", "a", 1, "x", "y"), (2, None, None, None, None, None, None),
        (None, words, "en", "a", 2, None, None), (3, "", "fr", "b", 0, "x", "y"), (4, " \n\t ", "fr", "b", 3, "x", "y"),
        (5, "one", "en", "a", 3, "x", "y"), (6, words + " tail", "en", "a", 4, "x", "y"), (None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


# --- components and SimHash ---


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (None, 3)]
    found = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}
    assert components.connected(spark.createDataFrame([], "x long, y long")).count() == 0


def test_tree_search_is_exact():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    near = base[rng.integers(0, 400, 1500)] ^ (np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64))
    values = np.unique(np.concatenate([base, near]))
    least = np.arange(len(values))
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    while True:
        now = np.where(close, least[None, :], len(values)).min(axis=1)
        if (now == least).all():
            break
        least = now
    assert (simhash.sets_within(values, 4) == least).all()


def test_near_duplicates(spark, docs):
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    ids = sorted(rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    values = np.array([simhash.simhash(texts[i]) for i in ids], dtype=np.int64).view(np.uint64)
    least = simhash.sets_within(np.unique(values), 4)
    group = {int(v): int(least[k]) for k, v in enumerate(np.unique(values))}
    first: dict[int, int] = {}
    for i, v in zip(ids, values):
        first.setdefault(group[int(v)], i)
    assert {i: rows[i].component_id for i in ids} == {i: first[group[int(v)]] for i, v in zip(ids, values)}
    assert all(rows[i].fingerprint == f"{int(v):016x}" for i, v in zip(ids, values))


def test_near_duplicates_odd(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.doc_id, r.component_id) for r in rows if r.fingerprint == "0" * 16} == {(2, 2), (3, 2), (4, 2), (None, 2)}
    assert {r.component_id for r in rows if r.doc_id == 1} == {1}
    assert simhash.near_duplicates(nothing).count() == 0


# --- Merkle trees ---


def test_edit_fingerprints(docs):
    rows = {r.doc_id: r for r in merkle.edit_fingerprints(docs).collect()}
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    for at, (doc_id, text) in enumerate(texts):
        half, after = len(text) // 2, texts[(at + 1) % len(texts)][1]
        edited = text[: len(text) - half] + after[:half]
        row = rows[doc_id]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and row.n_chars == len(text)
        assert (row.fingerprint == row.edited_fingerprint) == (edited == text) == (not row.edits)
        lines = [hashlib.sha256(x.encode()).hexdigest() for x in text.split("\n")]
        if "\n\n" not in text:
            section = hashlib.sha256("".join(lines).encode()).hexdigest()
            assert row.fingerprint == hashlib.sha256(section.encode()).hexdigest()
    assert sum(r.near_edited for r in rows.values()) > 5 * sum(r.near_next for r in rows.values())


def test_edit_fingerprints_odd(odd, nothing):
    rows = merkle.edit_fingerprints(odd).collect()
    assert len(rows) == odd.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (2, 3)}) == 1
    assert merkle.edit_fingerprints(nothing).count() == 0


def test_differing_branches(spark):
    frame = spark.createDataFrame([("a\nb\n\nc\nd", "a\nb\n\nc\nX\ne")], "l string, r string")
    left, right = merkle.merkle_tree(F.col("l")), merkle.merkle_tree(F.col("r"))
    found = frame.select(merkle.differing_branches(left, right).alias("x")).first().x
    assert [tuple(p) for p in found] == [(1, 1), (1, 2)]


# --- nearest neighbours ---


def test_nearest_neighbours(spark):
    frame = spark.read.parquet(f"{FOLDER}/../sf0.01/embeddings.parquet")
    rows = ann.nearest_neighbours(frame, F.col("vec_id") % 50 == 0).collect()
    table = frame.toPandas()
    vectors, ids = np.array(table.embedding.tolist(), dtype=float), table.vec_id.to_numpy()
    score = ann.cosines(vectors, vectors)
    np.fill_diagonal(score, -9)
    found, all_ = 0, 0
    for at in np.flatnonzero(ids % 50 == 0):
        own = sorted((r for r in rows if r.query_id == ids[at]), key=lambda r: r["rank"])
        best = sorted(range(len(ids)), key=lambda k: (-score[at, k], ids[k]))[:5]
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - score[at, list(ids).index(r.vec_id)]) < 1e-12 for r in own)
        found += len({r.vec_id for r in own} & {int(ids[k]) for k in best})
        all_ += 5
    assert found / all_ >= 0.9


def test_nearest_neighbours_odd(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (50, [1.0, 0.0]), (None, [1.0, 0.0]), (7, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.nearest_neighbours(frame, F.col("vec_id") % 50 == 0, k=2).collect()
    assert {(r.query_id, r["rank"], r.vec_id) for r in found} == {(0, 1, 1), (0, 2, 2), (50, 1, 0), (50, 2, 1)}
    assert ann.nearest_neighbours(frame.limit(0), F.lit(True)).count() == 0


def test_nearest_neighbours_in_blocks(spark, monkeypatch):
    draw = np.random.default_rng(3)
    rows = [(n, [float(x) for x in draw.normal(size=4)]) for n in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asks = F.col("vec_id") % 3 == 0
    whole = sorted(map(tuple, ann.nearest_neighbours(frame, asks, k=3, tables=2, probe=6).collect()))
    monkeypatch.setattr(ann, "BUCKET_ROWS", 4)
    monkeypatch.setattr(ann, "BUCKET_QUERIES", 4)
    assert sorted(map(tuple, ann.nearest_neighbours(frame, asks, k=3, tables=2, probe=6).collect())) == whole


def test_nearest_neighbours_in_groups(spark, monkeypatch):
    """More groups than partitions give the same rows as one."""
    frame = spark.read.parquet(f"{FOLDER}/../sf0.01/embeddings.parquet")
    asks = F.col("vec_id") % 3 == 0
    whole = sorted(map(tuple, ann.nearest_neighbours(frame, asks, k=3, tables=4).collect()))
    assert len(whole) == 3 * frame.filter(asks).count()
    monkeypatch.setattr(ann, "GROUP_BYTES", 1 << 13)
    assert sorted(map(tuple, ann.nearest_neighbours(frame, asks, k=3, tables=4).collect())) == whole


def _shuffled_mb(spark) -> float:
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(n).totalShuffleWrite() for n in range(executors.size())) / 1e6


def test_nearest_neighbours_shuffles_a_vector_once(spark):
    """Not once a table, nor a query once a probe, which filled disk and driver on large tables."""
    draw = np.random.default_rng(4)
    rows = [(n, [float(x) for x in x]) for n, x in enumerate(draw.normal(size=(3000, 64)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    before = _shuffled_mb(spark)
    assert len(ann.nearest_neighbours(frame, F.col("vec_id") % 50 == 0).collect()) == 300
    assert _shuffled_mb(spark) - before < 3 * 3000 * 64 * 4 / 1e6


def test_nearest_neighbours_broadcasts_no_vectors(spark):
    """Probing queries, 640 rows of a vector each, used to be broadcast by the size of the vectors alone."""
    frame = spark.read.parquet(f"{FOLDER}/../sf0.1/embeddings.parquet")
    found = ann.nearest_neighbours(frame, F.col("vec_id") % 50 == 0)
    assert len(found.collect()) == 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "Final Plan" in plan
    for below in final.split("BroadcastExchange")[1:]:
        own = re.split(r"\bExchange\b", below)[0]
        held = re.findall(r"MapIn\w+ .*\)#\d+, \[(.*?)\]", own)
        assert not any("embedding" in columns or "vector" in columns for columns in held)


def test_index_in_pieces(monkeypatch):
    """Few rows and queries of a bucket, queries and pairs at a time, and every row that the probed buckets hold."""
    draw = np.random.default_rng(2)
    vectors = np.concatenate([draw.normal(size=(400, 16)), np.outer(draw.uniform(1, 2, 50), np.ones(16))]).astype(np.float32)
    keys = draw.integers(0, 256, size=(450, 16), dtype=np.uint8)
    queries = vectors[::7]

    def found() -> list[tuple]:
        index = ann._Index(keys, vectors, 6, 10, 4)
        return sorted((int(q), int(r), s) for part in index.nearest(queries, 4) for q, r, s in zip(*part))

    units, asked = ann._units(vectors.astype(float)), ann._units(queries.astype(float))
    together = np.zeros((len(queries), len(vectors)), dtype=bool)
    for table in range(6):
        own, probed = ann.probes(units, table, 1, 6, 4)[:, 0], ann.probes(asked, table, 10, 6, 4)
        together |= (probed[:, :, None] == own[None, None, :]).any(axis=1)
    score = np.where(together, ann.cosines(queries.astype(float), vectors.astype(float)), -9)
    least = np.maximum(np.sort(score, axis=1)[:, -4, None], -2)
    expected = sorted((int(q), int(r), score[q, r]) for q, r in zip(*np.nonzero(score >= least)))
    assert 4 * len(queries) <= len(expected)
    assert found() == expected
    for name, value in (("BUCKET_ROWS", 3), ("BUCKET_QUERIES", 4), ("GROUP_QUERIES", 20), ("PAIRS", 100)):
        monkeypatch.setattr(ann, name, value)
    assert found() == expected


def test_nearest_neighbours_close_directions(spark):
    """Vectors that single precision can't tell apart, and such as have no squares in double precision, rank by their cosine."""
    rows = [(n, [1.0, n * 1e-7]) for n in range(1, 300)] + [(1000, [1.0, 0.0]), (1001, [1e200, 1e191]), (1002, [1e-200, 3e-209])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["rank"]: (r.vec_id, r.score) for r in ann.nearest_neighbours(frame, F.col("vec_id") == 1000, k=3).collect()}
    assert {found[n][0] for n in (1, 2)} == {1001, 1002} and found[3][0] == 1
    assert all(abs(score - 1) < 1e-12 for _, score in found.values())


def test_probes_by_matrix_are_those_by_steps():
    draw = np.random.default_rng(1)
    vectors = np.concatenate([draw.normal(size=(300, 64)), np.eye(64), draw.integers(-1, 2, size=(200, 64)) + np.eye(64)[0] * 3])
    units = ann._units(vectors)
    for table in range(3):
        for count in (1, 40):
            assert (ann.probes(units, table, count) == ann.probes(units, table, count, exact=True)).all()


# --- URL filter ---


def test_urls(spark):
    rows = [
        (1, "https://A.example.com/en/1"), (2, "http://www.example.com/en/2?x"), (3, "http://x.net/es/"), (4, "http://x.net/ES/"),
        (5, None), (6, "plain"), (7, "https://casino-pills.org/"), (8, "https://com#f"), (9, "https://sub.com/"),
        (10, "a://b://c/d"), (11, ""), (11, ""),
    ]
    model = url_filter.train(url_filter.labelled_urls(spark))
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("old"))
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(frame, RULES, model).collect()}
    assert found[1] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert found[2] == ("www.example.com", "/en/2", "www.example.com/en/", "allow")
    assert found[3][2:] == ("net/es/", "block") and found[4][2] is None
    assert found[5][:3] == found[6][:3] == found[11][:3] == ("", "", None) and found[7][2:] == (None, "block")
    assert found[8] == ("com", "", None, found[8][3]) and found[9][2:] == ("com/", "allow")
    assert found[10][:2] == ("b:", "//c/d")
    assert url_filter.judge_urls(frame.limit(0), RULES, model).count() == 0


def test_url_ngrams(spark):
    texts = [("", ""), ("a", "/"), ("é.org", "/x😀y/"), ("h" * 100_000, "/ab" * 100_000)]
    frame = spark.createDataFrame(texts, "host string, path string")
    for row in frame.select("host", "path", url_filter.ngrams(F.col("host"), F.col("path")).alias("grams")).collect():
        wanted = {
            mark + text[at : at + size] for mark, text in (("h", f"^{row.host}$"), ("p", f"^{row.path}$"))
            for size in (3, 4, 5) for at in range(max(len(text) - size + 1, 1))
        }
        assert len(row.grams) == len(wanted) and set(row.grams) == wanted


# --- quality ---


def test_kth_largest(spark):
    values = np.random.default_rng(3).normal(size=30_000).round(3)
    frame = spark.createDataFrame([(float(x),) for x in values], "v double")
    ordered = sorted(values, reverse=True)
    for k in (1, 17, 15_000, 30_000):
        assert quality.kth_largest(frame, k) == ordered[k - 1]
    assert quality.kth_largest(frame, 30_001) is None and quality.kth_largest(frame, 0) is None


def brute_ratio(texts, good):
    """Mean log likelihood ratio of each text's n-grams, plus that of its word pairs, from counts taken one by one."""

    def parts(text):
        data, words = text.encode(), text.encode().split()
        grams = (data[at : at + 4] for at in range(len(data) - 3))
        return (
            [((int.from_bytes(g, "big") * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> 48 for g in grams],
            [a == b for a, b in zip(words, words[1:])],
        )

    split = [parts(x) for x in texts]
    shares = []
    for chosen in (split, [parts(x) for x in good]):
        grams = Counter(g for x, _ in chosen for g in x)
        pairs = Counter(p for _, x in chosen for p in x)
        total, both = sum(grams.values()) + (1 << 16), sum(pairs.values()) + 2
        shares.append((lambda g, c=grams, n=total: math.log((c[g] + 1) / n), lambda p, c=pairs, n=both: math.log((c[p] + 1) / n)))
    (raw_gram, raw_pair), (gram, pair) = shares
    return [
        sum(gram(g) - raw_gram(g) for g in x) / max(len(x), 1) + sum(pair(q) - raw_pair(q) for q in y) / max(len(y), 1)
        for x, y in split
    ]


def test_quality(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.train(docs, labels)
    rows = {r.doc_id: r for r in quality.resample(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in rows}
    ids = sorted(texts)
    wanted = brute_ratio([texts[i] for i in ids], [texts[i] for i in ids if known.get(i) == 1])
    assert all(abs(rows[i].log_weight - w) < 1e-4 for i, w in zip(ids, wanted))
    over = sum(r.log_weight >= model.threshold for r in rows.values())
    assert sum(r.kept for r in rows.values()) == over
    assert min(r.gumbel_key for r in rows.values() if r.kept) > max(r.gumbel_key for r in rows.values() if not r.kept)
    assert sum(rows[i].kept == (q == 1) for i, q in known.items()) >= 0.95 * len(known)
    few = {r.doc_id for r in quality.resample(docs, model, k=60).filter("kept").collect()}
    best = set(sorted(rows, key=lambda i: -rows[i].log_weight)[:60])
    assert len(few) == 60 and few != best and len(few & best) > 30  # noise decides, weights lead
    assert quality.resample(docs, model, k=0).filter("kept").count() == 0
    assert quality.resample(docs, model, k=10**6).filter("NOT kept").count() == 0


def test_quality_draw(spark):
    """Equal weights are drawn evenly, others by their weight: the first of two draws follows the ratio of weights."""
    grams = np.zeros(quality.BUCKETS)
    grams[quality._buckets(np.frombuffer(b"abcd", dtype=np.uint8))] = math.log(3)
    model = quality.Ratio(grams, np.zeros(2))
    pair = spark.createDataFrame([(1, "abcd"), (2, "xyzw")], "doc_id long, text string")
    wins = sum(quality.resample(pair, model, k=1, length=1.0, seed=n).filter("kept").first().doc_id == 1 for n in range(40))
    assert 20 < wins < 40  # 30 expected
    assert quality.resample(pair, model, k=1, length=1e6).filter("kept").first().doc_id == 1


def test_quality_texts(spark):
    """A text of a million words is counted whole; columns named like internal ones do no harm; equal keys stay together."""
    rows = [(1, "good words here " * 333_334, 7, 7.0), (2, "bad bad bad", 8, 8.0), (2, "bad bad bad", 8, 8.0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int, log_weight double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0)], "doc_id long, quality int")
    model = quality.train(frame, labels)
    found = sorted((r.doc_id, r.log_weight, r.kept) for r in quality.resample(frame, model).collect())
    held = quality.Ratio(model.grams.astype(np.float32), model.pairs)
    assert abs(found[0][1] - held.of(rows[0][1])) < 1e-6 * abs(found[0][1]) and found[0][2]
    assert found[1] == found[2] and not found[1][2]


def test_quality_odd(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert quality.resample(odd, quality.train(odd, labels)).count() == odd.count()
    none = labels.limit(0)
    assert {r.kept for r in quality.resample(odd, quality.train(odd, none)).collect()} == {True}
    assert quality.resample(nothing, quality.train(nothing, none)).count() == 0


# --- packing ---


def test_packing(spark, docs, odd, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    for frame in (docs, odd.filter("doc_id is not null").distinct()):
        pieces = packing.pack_documents(frame, tokenizer_path()).toPandas()
        for doc_id, text in ((r.doc_id, r.text) for r in frame.collect()):
            ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
            own = pieces[pieces.doc_id == doc_id].sort_values("start")
            assert b"".join(own.ids) == ids.tobytes() and set(own.doc_tokens) == {len(ids)}
            assert all(zlib.crc32(x) == c for x, c in zip(own.ids, own.ids_crc32))
        lengths = []
        for _, one in pieces.groupby("sequence_id"):
            one = one.sort_values("offset")
            ends = (one.offset + one.length).tolist()
            assert one.offset.tolist() == [0, *ends[:-1]] and ends[-1] & (ends[-1] - 1) == 0 and ends[-1] <= 4096
            lengths.append(ends[-1])
        tasks = pieces.sequence_id.floordiv(packing.PER_TASK).nunique()
        assert sum(n < 4096 for n in lengths) <= 12 * tasks
        whole = sum(n // 4096 for n in pieces.groupby("doc_id").doc_tokens.first())
        assert len(pieces) <= frame.count() + whole + len(lengths)  # a cut a sequence at most
    assert packing.pack_documents(odd, tokenizer_path(), keep_ids=False).filter("start = 0").count() == odd.count()
    assert packing.pack_documents(nothing, tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs, tokenizer_path(), capacity=1000)


@pytest.mark.parametrize("capacity,classes", [(64, 8), (4096, 32), (1, 32), (2, 1)])
def test_bins(capacity, classes):
    """Every token once, in gapless sequences; a bin of class k starts with exactly k documents of its class."""
    rng = np.random.default_rng(capacity)
    sizes = [*rng.integers(1, 3 * capacity, 200).tolist(), *[1] * 300, *rng.integers(1, capacity // 3 + 2, 500).tolist()]
    bins, rows = packing.HarmonicBins(capacity, 7, classes), []
    for doc_id, size in enumerate(sizes):
        rows += bins.put(packing.Piece(doc_id, 0, np.full(size, doc_id, dtype="<u4").tobytes(), size))
        assert not bins.space or not any(bins.waiting)
        assert all(len(x) < k for k, x in enumerate(bins.waiting) if k)
    early = len(rows)
    rows += bins.close()
    held, sequences = Counter(), {}
    for at, (piece, sequence, offset) in enumerate(rows):
        own = sequences.setdefault(sequence, [])
        assert offset == sum(map(len, own)) and set(np.frombuffer(piece.ids, dtype="<u4")) == {piece.doc_id}
        own.append(piece)
        held.update((piece.doc_id, n) for n in range(piece.start, piece.start + len(piece)))
    assert set(held.values()) == {1} and len(held) == sum(sizes)
    assert min(sequences) == 7 and max(sequences) == 6 + len(sequences)
    short = [n for n in (sum(map(len, x)) for x in sequences.values()) if n < capacity]
    assert all(n & (n - 1) == 0 for n in short) and len(short) == len(set(short))
    for own in {sequence: sequences[sequence] for _, sequence, _ in rows[:early]}.values():
        kind = min(capacity // len(own[0]), classes)
        assert all(min(capacity // len(x), classes) == kind for x in own[:kind])


def test_packing_long(spark):
    """A text of a million words becomes whole sequences and a rest."""
    frame = spark.createDataFrame([(1, "word " * 1_000_000, "x")], "doc_id long, text string, length string")
    pieces = packing.pack_documents(frame.coalesce(1), tokenizer_path(), keep_ids=False).toPandas()
    assert pieces.length.sum() == 1_000_001 and (pieces.length == 4096).sum() == 1_000_001 // 4096


# --- substring ---


def brute_repeats(rows, window=20):
    seen, out = {}, {}
    for doc_id, text in sorted(rows):
        words = text.encode().split()
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen and seen[key] < (doc_id, at):
                gone[at : at + window] = [True] * window
            seen.setdefault(key, (doc_id, at))
        out[doc_id] = b" ".join(w for w, g in zip(words, gone) if not g).decode()
    return out


@pytest.mark.parametrize("window", [20, 9, 33])
def test_repeats(spark, window):
    rng = np.random.default_rng(window)
    shared = [" ".join(f"s{k}x{i}" for i in range(70)) for k in range(3)]
    rows = []
    for i in range(60):
        text = " ".join(f"d{rng.integers(0, 4000)}" for _ in range(int(rng.integers(0, 60))))
        a, n = int(rng.integers(0, 40)), int(rng.integers(5, 30))
        rows.append((i, f"{text} {' '.join(shared[i % 3].split()[a : a + n])} end {text if i % 5 == 0 else ''}"))
    rows += [(100 + i, rows[i][1]) for i in range(10)]
    found = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=window, batch_hashes=300)
    assert {r.doc_id: r.kept_text for r in found.collect()} == brute_repeats(rows, window)


def test_repeats_odd(odd, nothing):
    found = substring.remove_repeats(odd)
    assert set(odd.columns) - {"text"} <= set(found.columns)
    rows = sorted(((r.doc_id or 0, r.n_words, r.n_removed) for r in found.collect()))
    assert rows == [(0, 0, 0), (0, 45, 0), (1, 45, 0), (1, 45, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 1, 0), (6, 46, 45)]
    assert substring.remove_repeats(nothing).count() == 0


# --- archives ---


def test_archives(spark):
    rows = [(1, "u", "same"), (2, None, "same"), (3, "x\ny", None), (4, "u", ""), (None, "u", "same"), (5, "u", "é" * 9000),
            (5, "u", "é" * 9000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder, manifest = warc.write_archives(frame)
    back = warc.read_archives(folder, manifest).collect()
    assert len(back) == len(rows) and all(r.problem is None for r in back)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in back)
    assert kinds == [(0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None),
                     (5, "response", None), (5, "response", None)]
    assert all(r.payload_bytes == 18000 and bytes(r.payload).decode() == "é" * 9000 for r in back if r.page_id == 5)
    folder, manifest = warc.write_archives(frame, threshold=5)
    assert {r.record_type for r in warc.read_archives(folder, manifest, False).collect() if r.page_id != 5} == {"response"}
    folder, manifest = warc.write_archives(frame.limit(0))
    assert warc.read_archives(folder, manifest).count() == 0


def test_damaged_records():
    good = warc.record_bytes(1, "u", b"body", None)
    assert warc.parse_record(good)[-1] is None
    assert "length" in warc.parse_record(good[:-5])[-1]
    assert warc.parse_record(good.replace(b"body", b"BODY"))[-1] is not None
    assert "header" in warc.parse_record(good.replace(b"WARC-Date", b"X-Date"))[-1]
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(zstandard.ZstdCompressor().compress(good)[:-4])))


# --- toxicity ---


def test_grammar():
    t = toxicity
    assert t.matches([t.INSULT]) == [(t.INSULT, 0)]
    assert t.matches([t.TARGET, t.OTHER, t.INSULT]) == t.matches([t.INSULT, t.TARGET]) == [(t.INSULT, t.AIMED)]
    assert t.matches([t.NEGATION, t.OTHER, t.INSULT]) == [(t.INSULT, t.NEGATED)]
    assert t.matches([t.NEGATION, *[t.OTHER] * 4, t.INSULT]) == [(t.INSULT, 0)]
    assert t.matches([t.REPORT, t.THREAT, t.TARGET]) == [(t.THREAT, t.REPORTED | t.AIMED)]


@pytest.mark.parametrize("gap", range(5))
def test_aimed_threats(gap):
    t = toxicity
    marks = t.AIMED if gap <= t.REACH else 0
    assert t.matches([t.THREAT, *[t.OTHER] * gap, t.TARGET]) == [(t.THREAT, marks)]
    assert t.matches([t.TARGET, *[t.OTHER] * gap, t.THREAT]) == [(t.THREAT, marks)]


def test_grammar_against_positions():
    """The composed machine against rules read off the places of words in a clause."""
    t = toxicity
    rng = np.random.default_rng(9)
    for _ in range(3000):
        kinds = rng.choice(6, int(rng.integers(0, 12)), p=[0.35, 0.2, 0.2, 0.1, 0.1, 0.05]).tolist()
        wanted = []
        for at, kind in enumerate(kinds):
            if kind not in (t.INSULT, t.THREAT):
                continue
            near = kinds[max(at - t.REACH - 1, 0) : at + t.REACH + 2] if kind == t.THREAT else kinds
            marks = t.AIMED * (t.TARGET in near) | t.NEGATED * (t.NEGATION in kinds[max(at - t.SCOPE, 0) : at])
            wanted.append((kind, marks | t.REPORTED * (t.REPORT in kinds[:at])))
        assert sorted(t.matches(kinds)) == sorted(wanted)


def test_clause_weights():
    """Planted clauses: aimed matches weigh most, threats count unseen, negated and reported ones speak against."""
    t = toxicity
    lexicon = t.Lexicon(frozenset({"idiot"}), frozenset({"moro"}))
    texts = {
        "a fine day for you": (0, 0, 0, 0), "such an idiot": (1, 0, 0, 0), "you idiot": (1, 1, 0, 0), "Morons, them": (1, 1, 0, 0),
        "you are not an idiot": (0, 0, 0, 1), "she said you idiot": (0, 0, 0, 1), "we will hurt you": (0, 0, 1, 0),
        "kill the engine": (0, 0, 0, 0), "never kill you": (0, 0, 0, 1), "idiot. you": (1, 0, 0, 0), "": (0, 0, 0, 0),
    }
    for text, counts in texts.items():
        assert t.features(text, lexicon).tolist() == np.log2(1 + np.array(counts)).tolist(), text
    rng = np.random.default_rng(2)
    toxic = (rng.random(400) < 0.2).astype(float)
    seen = np.column_stack([toxic * (rng.random(400) < 0.9), toxic * (rng.random(400) < 0.5), 0 * toxic, toxic * (rng.random(400) < 0.1)])
    seen[:, 1] *= seen[:, 0]
    weights = t._fit(seen, toxic)
    assert weights[0] > 0 <= weights[1] and abs(weights[2] - weights[:2].sum()) < 1e-6 and weights[3] <= 0
    model = t.Model(lexicon, weights)
    assert model.score("we will hurt you") == pytest.approx(model.score("you idiot"), abs=1e-6)
    assert model.score("you idiot") >= model.score("such an idiot") > 0.5 > model.score("she said you idiot")
    assert model.score("kill the engine") == model.score("") >= model.score("you are not an idiot")


def test_toxic_long():
    """A clause of a million words: time grows with its length, and every match counts."""
    lexicon = toxicity.Lexicon(frozenset({"idiot"}), frozenset())
    assert toxicity.features("you " + "idiot " * 1_000_000, lexicon)[1] == np.log2(1_000_001)


def test_toxicity(spark, odd, nothing):
    docs = spark.read.parquet(f"{FOLDER}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/../sf0.01/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = toxicity.score_toxicity(docs, model).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    away = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in away) >= 0.9 * len(away)
    assert not any(r.predicted for r in away if not r.toxic)
    assert {r.predicted for r in toxicity.score_toxicity(odd, model).collect()} == {0}
    assert toxicity.score_toxicity(nothing, model).count() == 0
    assert toxicity.score_toxicity(odd, toxicity.train(odd, labels.limit(0))).count() == odd.count()


# --- mixing ---


def test_mixing(spark, docs, odd, nothing):
    mixed = mixing.mix(docs).toPandas()
    total = (mixed.tokens * mixed.weight).sum()
    for margin in ("source", "lang", "topic"):
        held = (mixed.tokens * mixed.weight).groupby(mixed[margin]).sum() / total
        wanted = mixed.groupby(margin).tokens.sum() ** 0.5
        assert np.abs(held - wanted / wanted.sum()).max() < 0.01
    assert abs((mixed.tokens * mixed.probability).sum() / mixed.tokens.sum() - mixing.BUDGET) < 1e-9
    found = mixing.mix(odd)
    assert found.count() == odd.count() and {"block", "copies"} <= set(found.columns)
    assert mixing.mix(nothing).count() == 0
    target = {"lang": spark.createDataFrame([("en", 3.0), ("xx", 5.0)], "lang string, share double")}
    assert {r.lang for r in mixing.mix(docs, target, margins=("lang",)).filter("sampled").collect()} == {"en"}
