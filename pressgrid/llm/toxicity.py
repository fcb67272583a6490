"""Toxicity scores from a weighted finite-state grammar over clauses."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgrid.sources.staging import stage

#: Labelled rows that lexicon and weights are fitted on at most.
LABELLED_ROWS = 20_000
#: Entries that a lexicon is chosen from at most, and what one must show: toxic texts that have it, and how much likelier
#: it is in a toxic text than in another.
ENTRIES, LEAST_TEXTS, LEAST_ODDS = 5_000, 5, 25.0
#: Share of the toxic texts from which on an entry is taken at once; others must explain texts that no other does.
STRONG = 0.05
#: Share of the toxic texts with an entry that must differ in the words beside it.
VARIED = 0.75
STEMS = (4, 5, 6)
#: Words after a negation that it still covers, and words between a threatening verb and the one it is aimed at.
SCOPE, REACH = 3, 2
SEED = 5

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;:\n]")

# Fixed word lists of the grammar, in the four languages of the documents.
THREATS = frozenset((
    "kill", "killed", "hurt", "beat", "destroy", "attack", "burn", "shoot", "stab", "smash", "töten", "umbringen",
    "schlagen", "zerstören", "tuer", "frapper", "détruire", "brûler", "matar", "pegar", "destruir", "quemar",
))
TARGETS = frozenset((
    "you", "your", "yours", "they", "them", "he", "him", "she", "her", "people", "everyone", "du", "dich", "dein", "ihr",
    "euch", "sie", "tu", "toi", "vous", "ton", "votre", "il", "elle", "ils", "elles", "usted", "ustedes", "ellos", "ellas", "él",
))
NEGATIONS = frozenset((
    "not", "never", "no", "nor", "without", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "sans", "nunca", "sin",
))
REPORTS = frozenset((
    "said", "says", "say", "reported", "claimed", "quoted", "wrote", "called", "sagte", "sagt", "berichtete", "behauptete",
    "dit", "déclare", "affirme", "dijo", "dice", "afirma",
))

#: Word classes, the input of the first transducer.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
#: Classes of matches, the output of the last: bits of an insult or a threat that is aimed, negated, or reported.
AIMED, NEGATED, REPORTED = 1, 2, 4


class Transducer:
    """A deterministic machine: ``step(state, symbol)`` gives the next state and the symbols that go out."""

    start: object = 0

    def step(self, state, symbol: tuple) -> tuple[object, tuple]:
        return state, (symbol,)


class Negating(Transducer):
    """Marks insults and threats within ``SCOPE`` words of a negation before them."""

    def step(self, state, symbol):
        kind, marks = symbol
        if kind == NEGATION:
            return SCOPE, (symbol,)
        if kind in (INSULT, THREAT) and state:
            symbol = (kind, marks | NEGATED)
        return (0 if kind == END else max(state - 1, 0)), (symbol,)


class Reporting(Transducer):
    """Marks what follows a verb of reporting, up to the end of the clause."""

    def step(self, state, symbol):
        kind, marks = symbol
        if kind in (INSULT, THREAT) and state:
            symbol = (kind, marks | REPORTED)
        return int(kind == REPORT or (state and kind != END)), (symbol,)


class Threatening(Transducer):
    """Aims threats: a threatening verb and a target with at most ``REACH`` words between them, in either order.

    State: words left in which a verb still meets the target before it, and verbs that still wait for one, at most
    ``REACH`` + 1 of them. A verb that meets none goes out unaimed.
    """

    start = (0, ())

    def step(self, state, symbol):
        near, waiting = state
        kind, marks = symbol
        if kind == TARGET:
            return (REACH + 1, ()), tuple((THREAT, m | AIMED) for m, _ in waiting) + (symbol,)
        out = tuple((THREAT, m) for m, left in waiting if not left or kind == END)
        waiting = () if kind == END else tuple((m, left - 1) for m, left in waiting if left)
        if kind == END:
            return self.start, out + (symbol,)
        if kind == THREAT and not near:
            return (0, (*waiting, (marks, REACH))), out
        if kind == THREAT:
            symbol = (kind, marks | AIMED)
        return (max(near - 1, 0), waiting), out + (symbol,)


class Aiming(Transducer):
    """Marks insults of a clause that names a target, before or after: they wait, linked, for the clause to end."""

    start = (0, None)

    def step(self, state, symbol):
        target, waiting = state
        kind, marks = symbol
        if kind == END:
            out = [symbol]
            while waiting:
                (k, m), waiting = waiting
                out.append((k, m | AIMED * (target and k == INSULT)))
            return self.start, tuple(reversed(out[1:])) + (symbol,)
        if kind == TARGET:
            return (1, waiting), ()
        if kind in (INSULT, THREAT):
            return (target, (symbol, waiting)), ()
        return state, ()


class Composed(Transducer):
    """The second machine reads what the first one writes."""

    def __init__(self, first: Transducer, second: Transducer):
        self.first, self.second, self.start = first, second, (first.start, second.start)

    def step(self, state, symbol):
        a, b = state
        a, middle = self.first.step(a, symbol)
        out = ()
        for each in middle:
            b, more = self.second.step(b, each)
            out += more
        return (a, b), out


GRAMMAR = Composed(Composed(Composed(Negating(), Reporting()), Threatening()), Aiming())
#: Features of a text, and what their weights are before any text is seen: insults, those of them that are aimed, aimed
#: threats (a null weight: the same as an aimed insult's), and matches that are negated or reported.
FEATURES = ("insults", "aimed_insults", "aimed_threats", "excused")
PRIOR = (2.0, 1.0, None, -1.0)
#: Bounds of the weights: aimed matches weigh at least as much as unaimed ones, excused ones never speak for toxicity.
SIGNS = np.array([1.0, 1.0, 1.0, -1.0])


def matches(classes: Iterable[int]) -> list[tuple[int, int]]:
    """The (kind, marks) that a clause of word classes yields, from the composed grammar."""
    state, found = GRAMMAR.start, []
    for kind in (*classes, END):
        state, out = GRAMMAR.step(state, (kind, 0))
        found += [x for x in out if x[0] in (INSULT, THREAT)]
    return found


@dataclass(frozen=True)
class Lexicon:
    """Insults: whole words, and stems that words start with."""

    words: frozenset[str]
    stems: frozenset[str]

    def kind(self, word: str) -> int:
        if word in self.words or any(word[:n] in self.stems for n in STEMS):
            return INSULT
        for kind, known in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            if word in known:
                return kind
        return OTHER


@lru_cache(maxsize=2)
def _finder(lexicon: Lexicon) -> ahocorasick.Automaton:
    """Finds every place where a word of an insult or threat may start; the lexicon then judges the word."""
    finder = ahocorasick.Automaton()
    for entry in lexicon.words | lexicon.stems | THREATS:
        finder.add_word(entry, len(entry))
    finder.make_automaton()
    return finder


def features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """Binary logarithms of one plus the matches of each kind in ``FEATURES``; threats that are not aimed are none."""
    counts = np.zeros(len(FEATURES))
    low = (text or "").lower()
    finder = _finder(lexicon)
    if not low or not len(finder):
        return counts
    done = 0
    for last, size in finder.iter(low):
        at = last - size + 1
        if at < done or (at and low[at - 1].isalpha()):
            continue
        begin = max((low.rfind(x, done, at) for x in ".!?;:\n"), default=-1) + 1
        begin = max(begin, done)
        end = m.start() if (m := _CLAUSE_END.search(low, at)) else len(low)
        for kind, marks in matches(lexicon.kind(w) for w in _WORD.findall(low, begin, end)):
            if kind == THREAT and not marks & AIMED:
                continue
            if marks & (NEGATED | REPORTED):
                counts[3] += 1
            elif kind == THREAT:
                counts[2] += 1
            else:
                counts[:2] += (1, marks & AIMED)
        done = end
    return np.log2(1 + counts)


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # of the features, then the constant

    def score(self, text: str | None) -> float:
        value = float(features(text, self.lexicon) @ self.weights[:-1] + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def _entries(text: str | None) -> set[str]:
    """Candidates of a text: its words, and stems of them, which end in ``*``."""
    words = set(_WORD.findall((text or "").lower()))
    return {w for w in words if 3 <= len(w) <= 40} | {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n}


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.iloc[at : at + 2000]
            kinds = (Counter(), Counter())
            for text, toxic in zip(part["text"], part["toxic"]):
                kinds[int(toxic)].update(_entries(text))
            for toxic, counts in enumerate(kinds):
                if counts:
                    yield pd.DataFrame({
                        "entry": pd.Series(list(counts), dtype=object), "toxic": toxic, "n": list(counts.values()),
                    })


def _contexts(text: str | None, entries: set[str]) -> dict[str, int]:
    """Entries found in a text, each with the least hash of the words right before and after it.

    Copies of a text, edited or not, nearly always agree in it; texts that merely share the entry do not.
    """
    words, found = ["", *_WORD.findall((text or "").lower()), ""], {}
    for before, word, after in zip(words, words[1:], words[2:]):
        for entry in (word, *(f"{word[:n]}*" for n in STEMS if len(word) >= n)):
            if entry in entries:
                place = zlib.crc32(f"{before} {after}".encode())
                found[entry] = min(place, found.get(entry, place))
    return found


def learn_lexicon(sample: DataFrame, entries: int = ENTRIES) -> Lexicon:
    """Words and stems that mark the toxic texts of ``sample`` (``text``, ``toxic``), at most ``entries`` of them.

    Those that many toxic texts share are taken at once. The rest must cover texts not yet explained, the one that covers
    most first, so that words which merely stand beside an insult in a few texts are left out. So are words of copied
    passages, which always stand between the same words.
    """
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon(frozenset(), frozenset())
    counts = sample.mapInPandas(_counted, "entry string, toxic int, n long").groupBy("entry").agg(
        F.sum(F.col("n") * F.col("toxic")).alias("bad"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("fine")
    )
    odds = (F.col("bad") / sizes[1]) / ((F.col("fine") + 0.5) / sizes[0])
    rows = counts.filter((F.col("bad") >= LEAST_TEXTS) & (odds >= LEAST_ODDS)).orderBy(F.desc("bad"), "entry").limit(
        entries
    ).collect()
    bad, fine = {r["entry"]: r["bad"] for r in rows}, {r["entry"]: r["fine"] for r in rows}
    for stem in [x for x in bad if x.endswith("*")]:  # where something longer does as well and fits fewer other texts
        if any(len(x) >= len(stem) and x.startswith(stem[:-1]) and x != stem and bad[x] >= 0.9 * bad[stem]
               and fine[x] <= fine[stem] for x in bad):
            del bad[stem]

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                found = _contexts(text, wanted)
                yield pd.DataFrame({"entry": pd.Series(list(found), dtype=object), "place": list(found.values())})

    wanted = set(bad)
    spots = sample.filter("toxic = 1").select("text").mapInPandas(placed, "entry string, place long")
    varied = {r["entry"]: r["n"] for r in spots.distinct().groupBy("entry").agg(F.count("entry").alias("n")).collect()}
    bad = {x: n for x, n in bad.items() if varied.get(x, 0) >= VARIED * n}
    chosen = {x for x, n in bad.items() if n >= STRONG * sizes[1]}

    @F.pandas_udf("array<string>")
    def known(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(_entries(x) & bad.keys()) for x in texts])

    texts = [set(r[0]) for r in sample.filter("toxic = 1").select(known("text")).collect()]  # bounded like the sample
    texts = [x for x in texts if not x & chosen]
    while texts:
        support = Counter(entry for text in texts for entry in text)
        best = max(support, key=lambda x: (support[x], -fine[x], len(x), x), default=None)
        if best is None or support[best] < LEAST_TEXTS:
            break
        chosen.add(best)
        texts = [x for x in texts if best not in x]
    stems = frozenset(x[:-1] for x in chosen if x.endswith("*"))
    return Lexicon(frozenset(x for x in chosen if not x.endswith("*")), stems)


def _fit(x: np.ndarray, y: np.ndarray, strength: float = 1.0, rounds: int = 200) -> np.ndarray:
    """Logistic regression with prior weights and signs, by projected Newton steps; both classes weigh the same.

    The prior draws each weight to ``PRIOR``, that of aimed threats to the sum of an aimed insult's two, so that what
    the texts teach about one holds for the other where they show none.
    """
    design = np.column_stack([x, np.ones(len(x))])
    weigh = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    ties, aims = np.eye(5), np.array([PRIOR[0], PRIOR[1], 0.0, PRIOR[3], 0.0])
    ties[2, :2] = -1.0
    pulls = np.diag([strength] * 4 + [1e-3])
    signs = np.append(SIGNS, 0.0)

    def loss(w: np.ndarray) -> float:
        off = ties @ w - aims
        return float(weigh @ np.logaddexp(0, design @ w) - weigh @ (y * (design @ w)) + off @ pulls @ off / 2)

    weights = np.array([PRIOR[0], PRIOR[1], PRIOR[0] + PRIOR[1], PRIOR[3], -1.0])
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (weigh * (chance - y)) + ties.T @ pulls @ (ties @ weights - aims)
        curve = (design * (weigh * chance * (1 - chance))[:, None]).T @ design + ties.T @ pulls @ ties
        free = ~((signs != 0) & (weights == 0) & (slope * signs > 0))
        step = np.zeros(5)
        step[free] = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
        size, now = 1.0, loss(weights)
        while True:
            moved = weights - size * step
            moved = np.where(moved * signs < 0, 0.0, moved)
            if loss(moved) <= now or size < 1e-6:
                break
            size /= 2
        if np.abs(moved - weights).max() < 1e-9:
            break
        weights = moved
    return weights


def held_out(doc_id: Column) -> Column:
    """One row in five, by the CRC-32 of the id as text: never learned from. Null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> Model:
    """Learn lexicon and weights from ``labels.toxic`` of rows that are not held out, at most about ``most`` of them.

    Texts that are equal under the same label count once. Without labels of both kinds the model scores every text one
    half less a little.
    """
    known = labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id"))).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic")
    )
    share = min(1.0, most / max(known.count(), 1))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic").dropDuplicates()
    sample = stage(texts, "labelled")
    lexicon = learn_lexicon(sample)

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([features(x, lexicon).tolist() for x in texts])

    rows = sample.select(measured("text").alias("x"), "toxic").toPandas()  # bounded by ``most``
    if rows["toxic"].nunique() < 2:
        return Model(lexicon, np.append(np.zeros(len(FEATURES)), -0.01))
    return Model(lexicon, _fit(np.array(rows["x"].tolist()), rows["toxic"].to_numpy(dtype=float)))


def score_toxicity(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1, higher: likelier toxic), ``predicted`` (1 from one half on).

    Clauses that hold an insult or a threat run through the composed grammar (negation, reported speech, target);
    matches are counted by class and weighted. One pass over the texts, no shuffle. Null and empty texts have no
    matches and score like clean ones; very long texts are read whole, in time that grows with their length; repeated
    rows and texts that tie are scored alike; other columns are not read; an empty table gives no rows.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(x) for x in texts], dtype="float64")

    rows = docs.select(F.col(id_column).alias("doc_id"), score(F.col(text_column)).alias("score"))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
