"""Manifest, ranked search and pattern packing against brute force, and on odd inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pressgrid.llm import manifest, nra, pattern_packing
from pressgrid.llm.queries import tokenizer_path

SHAPE = "doc_id long, source string, lang string, n_chars long, text string, tree string, row long, part string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, repeated rows and ids, empty and very long texts, columns named like internal ones."""
    words = " ".join(f"Word{i}" for i in range(45))
    rows = [
        (1, "a", "en", 3, words), (1, "a", "en", 3, words), (1, "b", "en", 3, "other"), (None, "a", None, None, None),
        (2, None, "en", None, words + " tail"), (3, None, None, 0, ""), (4, "ä", "de", 1, " \n\t "), (5, "Z", "en", 2, "ONE"),
        (6, "a", "en", 9, "the " * 300_000 + "End"), (None, None, None, None, None), (20, "a", "fr", 4, "été Été"),
    ]
    return spark.createDataFrame([(*r, "t", 7, "p") for r in rows], SHAPE)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


# --- manifest ---


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text) -> str:
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def grown(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[at : at + 16])) for at in range(0, len(row), 16)])
    return levels


def climb(levels: list[list[str]], at: int, now: str) -> tuple[str, str]:
    proof = ""
    for row in levels[:-1]:
        run = row[at - at % 16 : at - at % 16 + 16]
        left, right = "".join(run[: at % 16]), "".join(run[at % 16 + 1 :])
        proof, now, at = proof + left + right, sha(left + now + right), at // 16
    return proof, now


def audited(rows) -> Counter:
    """The contract in plain Python."""
    trees = {}
    for row in rows:
        text = row.text
        if row.doc_id is not None and text is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0:
            text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        key = b"" if row.source is None else b"s" + row.source.encode()
        trees.setdefault(key, []).append((row.doc_id, leaf_of(row, row.text), leaf_of(row, text)))
    order = sorted(trees)
    levels = {}
    for key in order:
        trees[key].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        levels[key] = grown([leaf for _, leaf, _ in trees[key]])
    top = grown([levels[key][-1][0] for key in order])
    found = Counter()
    for at, key in enumerate(order):
        for place, (doc_id, leaf, other) in enumerate(trees[key]):
            low, now = climb(levels[key], place, other)
            high, now = climb(top, at, now)
            root = top[-1][0]
            found[doc_id, leaf, levels[key][-1][0], root, sha(low + high), now, now == root] += 1
    return found


def test_layout_is_recursive():
    for levels in range(1, 6):
        places = [
            manifest.address(levels, depth, np.arange(16**depth)) for depth in range(min(levels, 5))
        ]
        assert sorted(np.concatenate(places)) == list(range(manifest.count_nodes(levels)))
    # Of four levels the upper two come first; below them every subtree of two levels is contiguous.
    assert manifest.address(4, 1, np.array([0, 15])).tolist() == [1, 16]
    assert manifest.address(4, 3, np.arange(16)).tolist() == list(range(18, 34))


@pytest.mark.parametrize("levels", [2, 3, 4])
def test_manifest(spark, levels):
    rows = [(i * 7 % 1501, f"s{min(i % 90, 40)}" if i % 11 else None, None, i, f"Text {i}") for i in range(1501)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    found = Counter(tuple(r) for r in manifest.tampered_audit(docs, levels=levels).collect())
    assert found == audited(docs.collect())


def test_manifest_odd(spark, odd, nothing):
    found = Counter(tuple(r) for r in manifest.tampered_audit(odd).collect())
    assert found == audited(odd.collect())
    assert manifest.tampered_audit(nothing).count() == 0 and manifest.build_manifest(nothing).root is None
    (one,) = manifest.tampered_audit(odd.filter("source = 'Z'")).collect()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == sha("")


def test_equal_rows_and_order_of_input_do_not_matter(odd):
    assert manifest.build_manifest(odd).root == manifest.build_manifest(odd.repartition(7)).root
    assert manifest.build_manifest(odd).root != manifest.build_manifest(odd.filter("doc_id <> 5")).root


# --- ranked search ---


def ranked(docs, items, top):
    """All scores of all documents, then the best."""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(text):
        return pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    held = [(row.doc_id, Counter(terms(row.text))) for row in docs]
    number = sum(bool(c) for _, c in held)
    length = sum(sum(c.values()) for _, c in held)
    df = Counter(term for _, c in held for term in c)
    found = []
    for item_id, text in items:
        scores = []
        for doc_id, counts in held:
            m = 50 + 50 * sum(counts.values()) * number // length if length else 50
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 20 * m))
                for t in set(terms(text)) if counts[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        found += [(item_id, at, None if none else doc, -score) for at, (score, none, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(found, key=str)


def test_nra_settles_members_ties_and_scores():
    rng = np.random.default_rng(5)
    for trial in range(60):
        documents, top = int(rng.integers(1, 900)), int(rng.integers(1, 60))
        dense = rng.integers(0, 12 if trial % 2 else 10**6, (int(rng.integers(1, 9)), documents)) * (rng.random(documents) < 0.7)
        lists = []
        for row in dense:
            docs = np.flatnonzero(row)
            order = docs[np.argsort(-row[docs], kind="stable")]
            lists.append((order, row[order]))
        places, scores = nra.nra(lists, documents, top)
        total = dense.sum(axis=0)
        assert (scores == total[places]).all()
        bar = max(1, sorted(total)[-top] if documents >= top else 1)
        assert set(np.flatnonzero(total >= bar)) <= set(places.tolist())


def test_nra_stops_before_the_end_of_long_lists(monkeypatch):
    documents = 50_000
    impacts = np.concatenate([np.arange(1000, 900, -1), np.ones(documents - 100, dtype=np.int64)])
    reads = []
    monkeypatch.setattr(nra.np, "partition", lambda a, k, own=np.partition: reads.append(1) or own(a, k))
    nra.nra([(np.arange(documents), impacts)], documents, 10)
    assert len(reads) == 1


@pytest.mark.parametrize("batch", [3, 10_000])
def test_search(spark, batch):
    rng = np.random.default_rng(batch)
    rows = [(int(i), " ".join(rng.choice(["the", "The", "of", "x1", "été", "a_b", "rare", "z"], rng.integers(0, 30)))) for i in range(400)]
    items = [(1, "the of"), (2, "rare; RARE été"), (2, "z"), (3, ""), (None, "b x1 x1"), (4, None), (5, "absent"), (1, "the of")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        asked = spark.createDataFrame(items, "item_id long, text string")
        for limit in (100_000, 2):
            found = nra.search(docs, asked, top=7, pass_terms=limit).select("item_id", "rank", "doc_id", "score")
            assert sorted(map(tuple, found.collect()), key=str) == ranked(docs.collect(), dict.fromkeys(items), 7)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_search_odd(spark, odd, nothing):
    items = [(1, "word3 the"), (2, "été one tail end"), (None, None)]
    asked = spark.createDataFrame([(*x, "r") for x in items], "item_id long, text string, rank string")
    found = nra.search(odd, asked).collect()
    assert sorted(map(tuple, found), key=str) == ranked(odd.collect(), items, 50)
    assert nra.search(nothing, asked).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert nra.search(odd, empty).columns == ["item_id", "rank", "doc_id", "score"] and nra.search(odd, empty).count() == 0


# --- pattern packing ---

PATH = tokenizer_path("byte_bpe_50k.json")


def test_space_encoder():
    from tokenizers import Tokenizer

    texts = [
        "  a  b ", " \n x\n\n  y", "a<|endoftext|> b", " lead", "tail ", "", "  x  y", "don't  'S  it's\tq \t z", "x \x1c y \x85 z",
        "a  b  c", "one two,three. four", "ünï   cödé 12 34a !!", "x" * 50, " ", "\n", "a \n", "<|endoftext|>", "Ġa Ġ b",
        "one.\nTwo three.\n\nFour\n five", "a\n\n\nb", "a\n\n", "\na", "\n\na", "a\n \nb", "a\t\nb", "a\n\tb", "a\r\nb", "a\n\n b",
        "a\n", "a b\nc&&& d$$$.\ne'\nf's g\u00a0\nh\ni,\u2003j", "x\n<|endoftext|>\ny", "a\n\x1cb", "\n", "a\n 'll b\n.\n..",
    ]
    plain = Tokenizer.from_file(PATH)
    for remember in (3, 1000):
        encode = pattern_packing.SpaceEncoder(PATH, remember)
        for _ in range(2):
            found = [np.frombuffer(x, "<u4").tolist() for x in encode(texts)]
            assert found == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]


def check_plan(histogram, capacity):
    plan, fitted = pattern_packing.plan_sequences(histogram, capacity)
    used = np.zeros(capacity + 1, dtype=np.int64)
    for contents, repeats in plan:
        assert repeats > 0 and sum(k * v for k, v in contents.items()) <= capacity
        for length, each in contents.items():
            used[length] += each * repeats
    assert (used == histogram).all()
    return sum(n for _, n in plan), fitted


def test_plans_come_close_to_best_fit_on_single_lengths():
    rng = np.random.default_rng(3)
    for size, low, high in ((5000, 1, 1024), (20_000, 200, 900), (3000, 1, 60), (4000, 400, 600)):
        histogram = np.bincount(rng.integers(low, high + 1, size), minlength=1025)
        sequences, fitted = check_plan(histogram, 1024)
        assert sequences <= 1.015 * sum(n for _, n in pattern_packing.pack_residuals(histogram, 1024))
        # Patterns of three cannot fill a sequence with pieces of 60.
        assert fitted > 0.5 * sequences or high == 60
    assert check_plan(np.zeros(1025, dtype=np.int64), 1024) == (0, 0)
    # Two of five tokens do not fit into nine; one of three goes beside each.
    assert check_plan(np.bincount([5, 5, 3, 3, 1], minlength=10), 9)[0] == 2


def test_fit_is_a_least_squares_fit():
    rng = np.random.default_rng(9)
    histogram = rng.integers(0, 40, 25).astype(float)
    histogram[0] = 0
    patterns = pattern_packing.enumerate_patterns(np.flatnonzero(histogram), 24)
    assert (patterns.sum(axis=1) == 24).all() and len({tuple(sorted(p)) for p in patterns.tolist()}) == len(patterns)
    x = pattern_packing.fit(patterns, histogram, steps=5000)
    a = np.array([np.bincount(p[p > 0], minlength=25) for p in patterns]).T.astype(float)
    slope = a.T @ (a @ x - histogram)
    assert (x >= 0).all() and slope.min() > -0.1 and abs(slope[x > 0.01]).max() < 0.1


def check_pieces(rows, docs, capacity):
    from tokenizers import Tokenizer

    plain, wanted = Tokenizer.from_file(PATH), Counter()
    for doc_id, text in docs:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        first, start, piece = len(ids) % capacity, 0, 0
        for length in ([first] if first else []) + [capacity] * (len(ids) // capacity):
            own = np.array(ids[start : start + length], "<u4").tobytes()
            wanted[doc_id, piece, start, length, zlib.crc32(own), len(ids)] += 1
            start, piece = start + length, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *(n for _, n in held[:-1])]).tolist() and sum(n for _, n in held) <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [1024, 64])
def test_pattern_packing(spark, capacity):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(6)
    rows = pattern_packing.pack_by_patterns(docs, PATH, capacity=capacity).collect()
    sequences = check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], capacity)
    assert sequences <= 1.02 * -(-sum(r.length for r in rows) // capacity) + 1
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_pattern_packing_odd(spark, odd, nothing):
    rows = pattern_packing.pack_by_patterns(odd, PATH, keep_ids=False).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in odd.collect()], 1024)
    assert pattern_packing.pack_by_patterns(nothing, PATH).count() == 0
    copies = spark.range(3000).selectExpr("id AS doc_id", "'same text' AS text")
    assert check_pieces(pattern_packing.pack_by_patterns(copies, PATH).collect(), [(i, "same text") for i in range(3000)], 1024) == 9
