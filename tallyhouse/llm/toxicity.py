"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters and digits to plain ones, all
else to single blanks. The lexicon (whole words, and stems that many words begin
with) is learned from labelled rows; words of stated benign phrases do not count.
A score is the weight found, normalised by length, through a logistic curve.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import small, stored
from tallyhouse.llm.lang_id import held_out

# Characters that stand in for Latin letters.
LOOKALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "l",
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m",
    "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}
# Phrases in which a word of the lexicon is harmless.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "take out the trash",
    "clown fish", "circus clown", "rodeo clown", "pond scum", "soap scum",
)
# The classifier is fitted on at most about this many labelled rows, chosen by hash.
TRAINING_ROWS = 20_000
# Terms that are looked at when the lexicon is put together: the most frequent ones.
CANDIDATES = 20_000
STEM = (4, 5, 6, 7, 8)

_FOLD = str.maketrans(LOOKALIKES | {chr(c): chr(c - 0xFEE0) for c in range(0xFF41, 0xFF5B)})
_OTHER = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """Words of plain letters with one blank around each; a blank for no words.

    A sign that stands for a letter does so only beside a letter; elsewhere it parts words.
    """
    lowered = (text or "").lower()
    if not lowered.isascii() or _SIGNS.search(lowered):
        lowered = _ALONE.sub(" ", lowered).translate(_FOLD)
    return f" {_OTHER.sub(' ', lowered).strip()} "


_SIGNS = re.compile(r"[0-9@$!|]")
_ALONE = re.compile(r"(?<![^\W\d_])[0-9@$!|]+(?![^\W\d_])|[@$!|]{2,}|(?<=[^\W\d_])[!|$@]+(?![^\W\d_])")


class Lexicon:
    """Patterns with weights, and the curve from weight to score."""

    def __init__(self, weights: dict[str, float], exceptions: Sequence[str]):
        self.weights, self.exceptions = weights, tuple(fold(e) for e in exceptions)
        self.slope, self.offset = 4.0, -4.0
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def _built(self):
        if self._automaton is None:
            automaton = ahocorasick.Automaton()
            for pattern, weight in self.weights.items():
                automaton.add_word(pattern, weight)
            automaton.make_automaton()
            # A benign phrase takes away what its own words would add.
            own = {p: sum(w for _, w in automaton.iter(p)) for p in self.exceptions}
            for phrase, weight in own.items():
                if weight:
                    automaton.add_word(phrase, automaton.get(phrase, 0.0) - weight)
            automaton.make_automaton()
            self._automaton = automaton
        return self._automaton

    def density(self, text: str | None) -> float:
        folded = fold(text)
        if not self.weights:
            return 0.0
        found = sum(w for _, w in self._built().iter(folded))
        return max(found, 0.0) / (1 + math.log1p(folded.count(" ") / 100))

    def score(self, density: float) -> float:
        return 1 / (1 + math.exp(-min(max(self.slope * density + self.offset, -30), 30)))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per word, toxic and clean, counted in the task."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush():
        words = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *(pa.array([c[w] for w in part], pa.int64()) for c in (counts[1], counts[0]))],
                names=["word", "toxic", "clean"],
            )
        for c in counts:
            c.clear()

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[toxic].update(set(fold(text).split()))
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield from flush()
    yield from flush()


def train(
    docs: DataFrame,
    labels: DataFrame,
    exceptions: Sequence[str] = EXCEPTIONS,
    rows: int = TRAINING_ROWS,
    precision: float = 0.8,
) -> Lexicon:
    """Learn the lexicon from ``toxic`` labels of ids that are not held out.

    Labels other than 0 and 1 and without id are passed over; of several labels of one
    id the larger counts. Without labels of both kinds the lexicon is empty.
    """
    known = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    total = known.count()
    share = min(1.0, rows / max(1, total))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(5), "_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    chosen = small(stored(chosen, "labels"), 2 * rows + 1000)
    sample = stored(
        docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("_id"), "text")
        .join(chosen, "_id").select("text", "toxic"),
        "labelled",
    )
    kinds = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = kinds.get(1, 0), kinds.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, exceptions)

    words = sample.mapInArrow(_terms, "word string, toxic long, clean long")
    words = words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    stems = [
        F.when(F.length("word") > n, F.concat(F.lit(" "), F.substring("word", 1, n))) for n in STEM
    ]
    whole = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    least = max(3, round(0.004 * toxic))
    candidates = (
        words.select(F.explode(F.array_compact(F.array(whole, *stems))).alias("pattern"), "toxic", "clean")
        .groupBy("pattern")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= least) & (F.col("toxic") >= precision * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.desc("toxic"), "pattern")
        .limit(CANDIDATES)
        .collect()
    )
    # Greedy cover: a pattern is worth what it finds in toxic rows that no chosen one has
    # found, so words that merely stand beside toxic ones do not enter.
    automaton = ahocorasick.Automaton()
    for i, row in enumerate(candidates):
        automaton.add_word(row.pattern, i)
    weights: dict[str, float] = {}
    if candidates:
        automaton.make_automaton()

        def match(batches):
            for batch in batches:
                found = [sorted({i for _, i in automaton.iter(fold(t))}) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], names=["found"])

        lists = sample.filter("toxic = 1").select("text").mapInArrow(match, "found array<long>").collect()
        weights = _cover(candidates, [r.found for r in lists], least, toxic, clean)
    lexicon = Lexicon(weights, exceptions)

    def measure(batches):
        for batch in batches:
            density = [lexicon.density(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(density, pa.float64()), batch.column("toxic")], names=["density", "toxic"]
            )

    binned = (
        sample.mapInArrow(measure, "density double, toxic int")
        .groupBy((F.round(F.least("density", F.lit(20.0)) * 20) / 20).alias("x"), "toxic")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    lexicon.slope, lexicon.offset = _logistic([(r.x, r.toxic, r.n) for r in binned])
    return lexicon


def _cover(candidates, lists, least: int, toxic: int, clean: int) -> dict[str, float]:
    of: dict[int, set[int]] = {}
    for doc, found in enumerate(lists):
        for i in found:
            of.setdefault(i, set()).add(doc)
    weights, left = {}, dict(of)
    while left:
        gain = {i: len(docs) for i, docs in left.items() if len(docs) >= least}
        if not gain:
            break
        best = max(gain, key=lambda i: (gain[i], len(candidates[i].pattern), candidates[i].pattern))
        row = candidates[best]
        weights[row.pattern] = math.log((row.toxic + 0.5) / (toxic + 1)) - math.log((row.clean + 0.5) / (clean + 1))
        found = left.pop(best)
        left = {i: rest for i, docs in left.items() if (rest := docs - found)}
    return weights


def _logistic(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset by Newton's method, slightly held back so that they stay finite."""
    x, y, n = (np.array(v, dtype=float) for v in zip(*points))
    design, theta = np.stack([x, np.ones_like(x)], 1), np.array([1.0, -2.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (n * (p - y)) + 1e-3 * theta
        hessian = (design * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - np.clip(step, -1, 1)
    return float(theta[0]), float(theta[1])


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts have no weight, and so the score of a text without hits.
    Whole texts are matched, each row on its own.
    """

    def run(batches):
        for batch in batches:
            scores = np.array([lexicon.score(lexicon.density(t)) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def not_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([lexicon.score(lexicon.density(t)) < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
