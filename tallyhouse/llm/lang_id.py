"""Language identification with interpolated Kneser-Ney models over characters.

Tasks count four-character runs per language; Spark adds the counts up and derives
from them what Kneser-Ney smoothing needs: totals and distinct successors of each
context, and in how many contexts each shorter run occurs. A run is its own 64-bit
key (16 bits a character), so no two runs share an entry and the model grows with the
corpus. Its entries are kept in sorted arrays of keys; a text gets the language of the
lowest cross-entropy per character.

A model of few bytes is broadcast. A larger one stays a table: texts are cut into
slices by hash, and each slice is joined to the entries of the runs that it holds.

Letters of the basic plane are their own code. Letters beyond it share 16-bit codes,
and all that is no letter is one code; that is the alphabet of the model.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import release, stored
from tallyhouse.operators.ranking import global_rank
from tallyhouse.session import shared_folder
from tallyhouse.sources.tables import TableFolder

ORDER = 4
DISCOUNT = 0.75
FLOOR = 1.0 / 65536
# Held-back texts that score as high as an accepted one must be right this often, per mille.
PRECISION = 995
# How sharp a score may be; likelihoods are summed as whole numbers of this fraction.
SHARPNESS = [2.0**i for i in range(-1, 7)]
UNIT = 2.0**-24
# A model is broadcast up to this size, at so many bytes an entry in its arrays.
MODEL_BYTES = 256 << 20
ENTRY_BYTES = 32
# Characters of a slice of texts that meets its entries in one task.
SLICE_CHARS = 32 << 20
PAD = chr(0x10FFFF)
CHUNK = 1 << 20  # characters handled at once
HELD_RUNS = 1 << 21  # distinct runs of a language that a task counts before it passes them on


@lru_cache(1)
def _fold() -> np.ndarray:
    """Code of each character: letters their own in 16 bits, the pad 0, the rest 1."""
    table = np.ones(0x110000, dtype=np.uint16)
    letters = np.array([c for c in range(0x110000) if chr(c).isalpha()])
    table[letters] = np.where(letters < 0x10000, letters, 2 + (letters * 40503) % 65521)
    table[0x10FFFF] = 0
    return table


def _chunks(texts: list[str]) -> Iterator[list[int]]:
    here, size = [], 0
    for i, text in enumerate(texts):
        here.append(i)
        size += len(text or "")
        if size >= CHUNK:
            yield here
            here, size = [], 0
    if here:
        yield here


def _runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of four characters ending at each character, its text, and texts with letters."""
    lowered = [(t or "").lower() for t in texts]
    joined = PAD * 3 + "".join(t + PAD * 3 for t in lowered)
    codes = _fold()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    owner = np.repeat(
        np.arange(len(texts) + 1), [3, *(len(t) + 3 for t in lowered)]
    ) - 1
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 1) | (codes[:-1] != 1)
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    runs = codes[3:] | codes[2:-1] << np.uint64(16) | codes[1:-2] << np.uint64(32) | codes[:-3] << np.uint64(48)
    real = codes[3:] != 0
    letters = np.zeros(len(texts), dtype=bool)
    letters[owner[codes > 1]] = True
    return runs[real], owner[3:][real], letters


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, bool], list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        keys = np.concatenate([k for k, _ in parts])
        counts = np.concatenate([n for _, n in parts])
        keys, at = np.unique(keys, return_inverse=True)
        return keys, np.bincount(at, counts, len(keys)).astype(np.int64)

    def rows(kind, keys, counts):
        for at in range(0, len(keys), 100_000):
            own = keys[at : at + 100_000].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([kind[0]] * len(own), pa.string()),
                    pa.array(own),
                    pa.array(counts[at : at + 100_000]),
                    pa.array([kind[1]] * len(own), pa.bool_()),
                ],
                names=["lang", "run", "n", "half"],
            )

    for batch in batches:
        by_kind: dict[tuple[str, bool], list[str]] = {}
        for lang, text, half in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "half"))):
            by_kind.setdefault((lang, half), []).append(text)
        for kind, own in by_kind.items():
            parts = held.setdefault(kind, [])
            for chunk in _chunks(own):
                parts.append(np.unique(_runs([own[i] for i in chunk])[0], return_counts=True))
                if len(parts) >= 16:
                    parts[:] = [merged(parts)]
            if len(parts) == 1 and len(parts[0][0]) > HELD_RUNS:
                yield from rows(kind, *parts.pop())
    for kind, parts in held.items():
        if parts:
            yield from rows(kind, *merged(parts))


class Entries:
    """Sorted keys of runs and contexts; per key and language, what smoothing needs.

    Part k - 1 holds runs of k characters with their discounted count, part ORDER + k - 1
    the contexts of these runs with back-off weight and total. Only pairs of key and
    language that occur have an entry.
    """

    def __init__(self, rows: pa.Table, width: int):
        part = rows.column("part").to_numpy()
        code = rows.column("code").to_numpy().view(np.uint64)
        order = np.lexsort((code, part))
        bounds = np.searchsorted(part[order], np.arange(2 * ORDER + 1))
        lang, value, total = (rows.column(c).to_numpy()[order] for c in ("lang", "value", "total"))
        self.width, self.parts = width, []
        for begin, end in zip(bounds, bounds[1:]):
            keys, first = np.unique(code[order[begin:end]], return_index=True)
            at = slice(begin, end)
            self.parts.append((keys, np.append(first, end - begin), lang[at], value[at], total[at]))

    def _look(self, part: int, wanted: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
        keys, first, lang, value, total = self.parts[part]
        values = np.full((len(wanted), self.width), default)
        totals = np.zeros((len(wanted), self.width))
        if len(keys):
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == wanted)
            begin = first[at[hit]]
            many = first[at[hit] + 1] - begin
            row = np.repeat(hit, many)
            place = np.arange(len(row)) + np.repeat(begin - (np.cumsum(many) - many), many)
            values[row, lang[place]], totals[row, lang[place]] = value[place], total[place]
        return values, totals

    def probabilities(self, runs: np.ndarray) -> np.ndarray:
        """Interpolated probabilities per language, order by order, from a uniform floor."""
        p = np.full((len(runs), self.width), FLOOR)
        for k in range(1, ORDER + 1):
            gram = runs & np.uint64((1 << 16 * k) - 1)
            count, _ = self._look(k - 1, gram, 0.0)
            weight, total = self._look(ORDER + k - 1, gram >> np.uint64(16), 1.0)
            p = count / np.maximum(total, 1) + weight * p
        return p

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character and language, and which texts have letters."""
        sums, letters = np.zeros((len(texts), self.width)), np.zeros(len(texts), dtype=bool)
        n = np.zeros(len(texts))
        for chunk in _chunks(texts):
            runs, owner, letters[chunk] = _runs([texts[i] for i in chunk])
            n[chunk] = np.bincount(owner, minlength=len(chunk))
            distinct, at = np.unique(runs, return_inverse=True)
            step = max(1, CHUNK // self.width)
            logs = np.concatenate(
                [np.log(self.probabilities(distinct[i : i + step])) for i in range(0, len(distinct), step)]
                or [np.zeros((0, self.width))]
            )
            for i in range(0, len(runs), step):
                own = owner[i : i + step]
                first = np.flatnonzero(np.diff(own, prepend=-1))
                sums[chunk[0] + own[first]] += np.add.reduceat(logs[at[i : i + step]], first, axis=0)
        return -sums / np.maximum(n, 1)[:, None], letters


@dataclass
class Curve:
    """From cross-entropies to a score, and what is rejected; learned on held-back texts."""

    sharpness: float = 1.0
    least: float = 0.0
    ceiling: float = math.inf


def _curve(judged: DataFrame) -> Curve | None:
    """Sharpness of the highest likelihood, then bounds that right texts keep, from all ``judged`` rows.

    ``least`` is the lowest score at and above which PRECISION of a thousand are right,
    ``ceiling`` a little over the highest cross-entropy of a text named rightly. Scores
    are ranked in slices; a few numbers come to the driver.
    """
    sums = judged.agg(
        *[F.sum(F.col("logs")[i]) for i in range(len(SHARPNESS))],
        F.max(F.when(F.col("named"), F.col("own"))), F.count(F.lit(1)),
    ).first()
    if not sums[-1]:
        return None
    best = max(range(len(SHARPNESS)), key=lambda i: sums[i])
    over = F.sum(F.when(F.col("named"), 1000 - PRECISION).otherwise(-PRECISION)).alias("over")
    scores = judged.groupBy(F.col("scores")[best].alias("score")).agg(over)
    folder = TableFolder(judged.sparkSession, f"{shared_folder(judged.sparkSession)}/language-{uuid.uuid4().hex}")
    ranked = global_rank(scores, [F.desc("score")], folder, "scores", value="over")
    good = F.min(F.when(F.col("running_total") >= 0, F.col("score")))
    least, lowest = ranked.agg(good, F.min("score")).first()
    folder.remove()
    return Curve(
        SHARPNESS[best],
        1.0 if least is None else 0.0 if least == lowest else least,
        math.inf if sums[-2] is None else 1.1 * sums[-2],
    )


@dataclass
class Model:
    """Languages, entries as a stored table and, if they are few, as arrays, and the curve."""

    langs: list[str]
    rows: DataFrame
    entries: Entries | None
    curve: Curve


def _posterior(entropies: np.ndarray, sharpness: float) -> np.ndarray:
    x = -sharpness * entropies
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids from which nothing is learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _entries(counts: DataFrame, discount: float) -> DataFrame:
    """Entries of all orders from counts of the longest runs (lang as a number, run, n)."""
    out = None
    for k in range(ORDER, 0, -1):
        grams = counts.select(
            F.lit(k - 1).alias("part"), F.col("run").alias("code"), "lang",
            (F.col("n") - discount).alias("value"), F.lit(0.0).alias("total"),
        )
        contexts = counts.groupBy("lang", F.shiftrightunsigned("run", 16).alias("code")).agg(
            F.sum("n").cast("double").alias("total"), F.count(F.lit(1)).alias("kinds")
        ).select(
            F.lit(ORDER + k - 1).alias("part"), "code", "lang",
            (discount * F.col("kinds") / F.col("total")).alias("value"), "total",
        )
        both = grams.unionByName(contexts)
        out = both if out is None else out.unionByName(both)
        shorter = F.col("run").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))
        counts = counts.groupBy("lang", shorter.alias("run")).agg(F.count(F.lit(1)).alias("n"))
    return out


def _model(counts: DataFrame, langs: list[str], discount: float, model_bytes: int) -> Model:
    rows = stored(_entries(counts, discount), "entries")
    few = rows.count() * ENTRY_BYTES <= model_bytes
    return Model(langs, rows, Entries(rows.toArrow(), len(langs)) if few else None, Curve())


def train(docs: DataFrame, discount: float = DISCOUNT, model_bytes: int = MODEL_BYTES) -> Model | None:
    """A model of every language in ``lang``, from all rows with text and lang; None without any.

    All rows are counted, however long. Repeated rows count as often as they stand there.
    The curve is learned from all of them too: they are halved by hash, equal texts
    together, and each half is scored by a model that has counted the other one only.
    """
    half = F.xxhash64(F.lit(3), "text") % 2 == 0
    rows = docs.filter("text is not null and lang is not null").select("lang", "text", half.alias("half"))
    counted = rows.mapInArrow(_count, "lang string, run long, n long, half boolean")
    top = stored(
        counted.groupBy("lang", "run").agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("half"), F.col("n")).otherwise(0)).alias("n_half")
        ),
        "runs",
    )
    langs = sorted(r.lang for r in top.select("lang").distinct().collect())
    if not langs:
        return None
    number = (F.array_position(F.lit(langs), F.col("lang")) - 1).cast("int").alias("lang")
    model = _model(top.select(number, "run", "n"), langs, discount, model_bytes)

    def judge(texts, own, entries):
        e, ok = entries.entropies(texts)
        right = np.array([langs.index(x) for x in own.column("lang").to_pylist()], dtype=np.int64)[ok]
        e, row = e[ok], np.arange(len(right))
        shares = [_posterior(e, s) for s in SHARPNESS]
        logs = np.stack([np.log(np.maximum(p[row, right], 1e-4)) for p in shares], axis=1)
        scores = np.stack([p.max(1) for p in shares], axis=1)
        return pa.RecordBatch.from_arrays(
            [
                _lists(np.rint(logs / UNIT).astype(np.int64)), _lists(scores),
                pa.array(e.argmin(1) == right), pa.array(e[row, right]),
            ],
            names=["logs", "scores", "named", "own"],
        )

    parts, without = [], []
    for held, n in (("half", F.col("n") - F.col("n_half")), ("not half", F.col("n_half"))):
        other = _model(top.select(number, "run", n.alias("n")).filter("n > 0"), langs, discount, model_bytes)
        schema = "logs array<long>, scores array<double>, named boolean, own double"
        parts.append(stored(_scored(rows.filter(held).select("lang", "text"), other, judge, schema), "judged"))
        without.append(other.rows)
    model.curve = _curve(parts[0].union(parts[1])) or model.curve
    release(top, *without, *parts)
    return model


def _lists(values: np.ndarray) -> pa.Array:
    """Each row of a table of numbers as a list."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _scored(rows: DataFrame, model: Model, finish: Callable, schema: str) -> DataFrame:
    """``finish(texts, batch, entries)`` over all rows, each with the entries of its runs."""
    width = len(model.langs)
    if model.entries is not None:
        shared = rows.sparkSession.sparkContext.broadcast(model.entries)

        def whole(batches):
            for batch in batches:
                yield finish(batch.column("text").to_pylist(), batch, shared.value)

        return rows.mapInArrow(whole, schema)

    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = size // SLICE_CHARS + 1
    rows = rows.withColumn("slice", F.pmod(F.xxhash64(*rows.columns), F.lit(slices)))

    def wanted(batches):
        for batch in batches:
            numbers, texts = batch.column("slice").to_numpy(), batch.column("text").to_pylist()
            for number in np.unique(numbers):
                own = [texts[i] for i in np.flatnonzero(numbers == number)]
                for chunk in _chunks(own):
                    runs = np.unique(_runs([own[i] for i in chunk])[0])
                    for k in range(1, ORDER + 1):
                        gram = runs & np.uint64((1 << 16 * k) - 1)
                        for part, code in ((k - 1, gram), (ORDER + k - 1, gram >> np.uint64(16))):
                            code = np.unique(code).view(np.int64)
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(np.full(len(code), number)),
                                    pa.array(np.full(len(code), part, np.int32)), pa.array(code),
                                ],
                                names=["slice", "part", "code"],
                            )

    asked = rows.select("slice", "text").mapInArrow(wanted, "slice long, part int, code long").distinct()
    entries = asked.join(model.rows, ["part", "code"])

    def apart(texts: pa.Table, entries: pa.Table) -> pa.Table:
        held = Entries(entries, width)
        out = [finish(b.column("text").to_pylist(), b, held) for b in texts.to_batches()]
        return pa.Table.from_batches(out)

    return rows.groupBy("slice").cogroup(entries.groupBy("slice")).applyInArrow(apart, schema)


def identify(docs: DataFrame, model: Model | None, least: float = 0.0) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, rejected.

    A null text, or one without letters, is ``und`` with score 0, as is every text if
    there is no model. A text whose score is below ``least`` is ``und`` with its score. The score is
    the calibrated share of the best language. ``rejected`` says that the score or the
    cross-entropy lies beyond the bounds learned from held-back texts, so that a caller
    may refuse the name; a text without letters is rejected. Texts are scored whole,
    however long, each row on its own, so repeated rows and extra columns make no
    difference; an empty table gives an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    if model is None:
        return rows.select(
            "doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
        )
    langs, curve = model.langs, model.curve

    def name(texts, own, entries):
        entropies, letters = entries.entropies(texts)
        p = _posterior(entropies, curve.sharpness)
        best = p.argmax(1)
        score = np.where(letters, p.max(1), 0.0)
        named = letters & (score >= least)
        rejected = ~letters | (score < curve.least) | (entropies.min(1) > curve.ceiling)
        return pa.RecordBatch.from_arrays(
            [
                own.column("doc_id"), own.column("held_out"),
                pa.array([langs[b] if ok else "und" for b, ok in zip(best, named)], pa.string()),
                pa.array(score, pa.float64()), pa.array(rejected),
            ],
            names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
        )

    return _scored(rows, model, name, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
