"""Personal data, hash trees and whitening against brute force, with the awkward rows each must take."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from tallyhouse.llm import decontaminate, merkle, mixing, pii, whitening
from tallyhouse.llm.common import small, stored
from tests.llm.test_text_operators import DOCS, LOWER, frame, words

# 11 ------------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


PRIVATE = [
    None, "", "nothing here", "mail a.b+c@mail-1.example.com now", "@x.y a@b a@b. a@b.c.", "a@b.cc@d.ee x@y@z.org",
    "ip 10.0.0.1, 1.2.3.256, 1.2.3.4.5.6.7.8, 001.002.003.004 0000300.1.1.1", "card 4539 1488 0343 6467 and 4539-1488-0343-6468",
    "2024 4539148803436467", "tel +1 (017) 555-7713, +12 3, +1--------, ++49 30 1234567+", "é\U0001F600 a@b.de \U0001F600 +49 30 123456",
    "iban DE89 3704 0044 0532 0130 00 AND GB82WEST12345698765432, DE88370400440532013000",
    "ssn 123-45-6789, order 123-45-6780, 000-12-3456", "call (030) 555-1234 or order 030-555-1234", "amex 378282246310005",
]


def test_base_spans_are_what_the_patterns_say(spark):
    rng = random.Random(11)
    alphabet = "aZ9.@+- (1234)0-%_5é\n"
    texts = PRIVATE + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(4000)]
    texts += ["".join(rng.choice("0123456789. -+@a") for _ in range(60)) for _ in range(4000)]
    for text in texts:
        found = [(s.kind, s.start, s.end) for s in pii.find_spans(text) if s.kind in pii.BASE]
        assert found == base_spans(text), text
    rows = [(i, t, "en", "a") for i, t in enumerate(PRIVATE)] + [(3, PRIVATE[3], "en", "a"), (None, PRIVATE[6], None, None)]
    found = pii.digest(pii.find(frame(spark, rows))).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    by_id = {i: t for i, t, _, _ in rows}
    for r in found:
        base = base_spans(by_id[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in PATTERNS]
        assert r.spans.startswith(listed)
    assert pii.find(frame(spark, rows).limit(0)).count() == 0


def test_added_kinds_need_their_check_and_their_context():
    def added(text):
        return [(s.kind, text[s.start : s.end]) for s in pii.find_spans(text) if s.kind not in pii.BASE]

    assert added(PRIVATE[11]) == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert added(PRIVATE[12])[:1] == [("social_number", "123-45-6789")] and ("social_number", "000-12-3456") not in added(PRIVATE[12])
    assert added("order 123-45-6789") == [] and added("on 123-45-6789 it") == [("social_number", "123-45-6789")]
    assert added("call (030) 555-1234") == [("local_phone", "(030) 555-1234")] and added("on (030) 555-1234") == []
    assert added(PRIVATE[14]) == [("short_card", "378282246310005")] and added("378282246310006") == []
    # A span of another kind never lies on a base span.
    assert added("phone +1 (017) 555-7713") == []
    low, high = (pii.find_spans(t)[0].score for t in ("a 4539148803436467", "credit card 4539148803436467"))
    assert low < high
    assert pii.redact_text("to a@b.de: 10.0.0.1") == "to [email]: [ip]" and pii.redact_text(None) is None


@pytest.mark.parametrize(
    "text", ["a" * 400_000, "a@" * 200_000, "1" * 400_000, "1." * 200_000, "1 " * 200_000, "+1" + "-" * 400_000, "+1" * 200_000,
             "AB12" * 100_000, "A1 " * 150_000, "(030) " * 70_000, "a." * 200_000 + "@" + "b." * 200_000],
    ids=lambda t: t[:6],
)
def test_long_texts_take_time_in_proportion(text):
    began = time.process_time()
    pii.find_spans(text)
    assert time.process_time() - began < 5


def test_redacted_rows_keep_their_columns(spark):
    rows = [(1, "to a@b.de", "en", "a"), (2, None, None, None)]
    out = pii.redact(frame(spark, rows))
    assert out.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert {r.doc_id: r.text for r in out.collect()} == {1: "to [email]", 2: None}


# 12 ------------------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, fold=False):
    i, text, lang, source = row
    n = None if text is None else len(text)
    text = text.translate(LOWER) if fold and text else text
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def runs_up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def plain_audit(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    order = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in order:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = runs_up([leaf_of(r) for r in by_lang[lang]])
    top = runs_up([trees[lang][-1][0] for lang in order])
    out = []
    for at, lang in enumerate(order):
        for pos, row in enumerate(by_lang[lang]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node, beside = leaf_of(row, tampered), []
            for levels, place in ((trees[lang], pos), (top, at)):
                for level in levels[:-1]:
                    run = level[place // 8 * 8 : place // 8 * 8 + 8]
                    beside += run[: place % 8] + run[place % 8 + 1 :]
                    run = run[: place % 8] + [node] + run[place % 8 + 1 :]
                    node, place = sha(*run), place // 8
            root = top[-1][0]
            out.append((row[0], leaf_of(row), trees[lang][-1][0], root, sha(*beside), node, node == root))
    return out


def many(rng, n):
    langs = [None, "", "de", "en", "é", "zz", *[f"l{i}" for i in range(8)]]
    rows = [(i, " ".join(words(rng, 3)).title(), rng.choice(langs[:5]) if i % 3 else "en", rng.choice(["a", None, "b:1"])) for i in range(n)]
    rows += [(n + i, f"Lone {lang}", lang, "a") for i, lang in enumerate(langs)]
    rows += [(7, "Again", "en", "a")] * 20 + [(7, "Other", "en", "a"), (None, "No Id", "en", "a"), (None, None, None, None)]
    return rows + [(n + 50, "", "en", ""), (n + 51, None, "en", "a"), (n + 52, "É ẞ A" * 30_000, "en", "a"), (2**60 + 1, "Large", "en", "a")]


@pytest.mark.parametrize("n", [40, 13_000])
def test_trees_and_proofs_like_brute_force(spark, n):
    rows = many(random.Random(12), n)
    got = [tuple(r) for r in merkle.audit(frame(spark, rows).repartition(5)).collect()]
    assert sorted(got, key=str) == sorted(plain_audit(rows), key=str)
    kinds = {(r[6], zlib.crc32(str(r[0]).encode()) % 3 == 0) for r in got if r[0] is not None}
    assert {(False, True), (True, False), (True, True)} >= kinds >= {(False, True), (True, False)}


def test_one_row_and_no_row(spark):
    rows = [(1, "Text", "en", "a")]
    (got,) = merkle.audit(frame(spark, rows)).collect()
    assert tuple(got) == plain_audit(rows)[0] and got.proof_sha256 == sha() and got.root == got.leaf
    assert merkle.audit(frame(spark, rows).limit(0)).collect() == []


def test_some_leaves_are_proved_with_the_fewest_nodes(spark):
    rng = random.Random(3)
    for _ in range(300):
        n = rng.choice([1, 2, 8, 9, 64, 65, 700])
        wanted = set(rng.sample(range(n), rng.randint(1, min(n, 12))))
        levels = runs_up([sha(str(i)) for i in range(n)])
        needed = merkle.missing(wanted, n)
        # Every node of a run on a path, less those that follow from the wanted leaves.
        known, expected = wanted, []
        for level, nodes in enumerate(levels[:-1]):
            parents = {p // 8 for p in known}
            expected += [(level, p) for p in range(len(nodes)) if p // 8 in parents and p not in known]
            known = parents
        assert sorted(needed) == sorted(expected)
    rows = many(random.Random(5), 9000)
    made = merkle.manifest(frame(spark, rows))
    some = made.leaves.filter("pos % 1000 = 3 or doc_id = 7")
    whole = {(r.doc_id, r.leaf, r.proof) for r in merkle.prove(made).collect()}
    part = [(r.doc_id, r.leaf, r.proof, r.folded_root) for r in merkle.prove(made, some).collect()]
    assert len(part) == some.count() > 20 and all(r[:3] in whole and r[3] == made.root for r in part)


# 13 ------------------------------------------------------------------------------------------------


def plain_whitening(vectors, components=32):
    x = np.floor(64 * np.asarray(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    deviations = (n * x - sums).astype(object)
    exact = (deviations**2).sum(axis=1)
    centred = deviations.astype(np.float64) / n
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, exact, centred @ (columns[:, order] / np.sqrt(values[order])), values[order] / values.sum()


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def matched(found, vectors, components):
    n, exact, white, explained = plain_whitening(list(vectors.values()), components)
    for at, vec_id in enumerate(vectors):
        own = found[vec_id]
        assert sorted(own) == list(range(1, components + 1))
        assert own[1].n == n and own[1].deviation == exact[at] and own[1].identity_error <= 1e-9
    for k in range(components):
        ours = np.array([found[i][k + 1].whitened for i in vectors])
        sign = np.sign(ours @ white[:, k])
        assert np.abs(ours - sign * white[:, k]).max() < 1e-6
        assert found[next(iter(vectors))][k + 1].explained == pytest.approx(explained[k], rel=1e-8)


VECTORS = "vec_id long, embedding array<double>, label int, vector string, n long, component int, whitened int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2, 3) for i, v in rows], VECTORS)


@pytest.mark.parametrize("spread", [1.0, 1e-4], ids=["even", "steep"])
def test_whitening_like_a_dense_eigensolver(spark, spread):
    rng = np.random.default_rng(13)
    scales = np.geomspace(1000, 1000 * spread, 40)
    x = rng.normal(size=(3000, 40)) * scales @ np.linalg.qr(rng.normal(size=(40, 40)))[0]
    odd = [(9000, None), (9001, []), (9002, [float("nan")] * 40), (9003, [None] * 40), (9004, [float("inf")] * 40), (9005, [1.0]), (9006, [1e300] * 40)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + odd
    df = vector_frame(spark, rows).repartition(7)
    found = collected(whitening.whitened_components(df))
    assert set(found) == set(range(3000))
    matched(found, dict(enumerate(x)), 32)


def test_whitening_of_tables_with_directions_that_do_not_exist(spark):
    rng = np.random.default_rng(14)
    base = rng.integers(-50, 50, size=(400, 3)).astype(float)
    # A constant dimension, a repeated one and a sum of two: three directions in six.
    x = np.column_stack([base, np.full(400, 7.0), base[:, 0], base[:, 1] + base[:, 2]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist()), (None, x[1].tolist())]
    found = whitening.whitened_components(vector_frame(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2, 3} and len(found) == 3 * 402 and found[0].identity_error < 1e-9
    white = np.array([[r.whitened for r in sorted(found, key=lambda r: r.component) if r.vec_id == i] for i in range(1, 400)])
    assert np.isfinite(white).all() and sum({r.component: r.explained for r in found}.values()) == pytest.approx(1)
    # Fewer rows than dimensions, nothing that varies, and nothing at all.
    few = whitening.whitened_components(vector_frame(spark, [(i, rng.normal(size=20).tolist()) for i in range(5)])).collect()
    assert {r.component for r in few} == {1, 2, 3, 4} and few[0].identity_error < 1e-9
    assert whitening.whitened_components(vector_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    empty = whitening.whitened_components(vector_frame(spark, rows).limit(0))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"


def test_exact_sums_beyond_64_bits():
    x = np.array([[2**55, 1], [-(2**55), 3]], dtype=np.int64)
    sums = [0, 4 << 60]
    deviations = whitening._deviations(x, 2**20, sums)
    assert deviations.tolist() == [[2**75, 2**20 - (4 << 60)], [-(2**75), 3 * 2**20 - (4 << 60)]]
    assert whitening._squares(deviations) == [None, None]
    assert whitening._squares(np.array([[3, 4]])) == [25] and whitening._squares(np.array([[2**32, 0]])) == [None]
    assert whitening._squares(np.array([[2**31, 2**31]])) == [2**63 if 2**63 < 2**63 else None]
    assert whitening._squares(np.array([[2**31, 2**30]])) == [2**62 + 2**60]


def test_large_documents_are_fitted_exactly():
    sizes, counts = [50_000, 80_000, 90_000], [2, 1, 1]
    for dp_words in (1, 1 << 16):
        assert mixing.fit(sizes, counts, 100_000, dp_words) == [2, 0, 0]
    assert mixing.fit([], [], 5) == [] and mixing.fit([0, 3], [4, 2], 6) == [0, 2]
    rng = random.Random(8)
    for _ in range(200):
        sizes = sorted(rng.sample(range(1, 60), rng.randint(1, 8)))
        counts = [rng.randint(1, 4) for _ in sizes]
        budget = rng.randint(0, sum(s * n for s, n in zip(sizes, counts)))
        got = mixing.fit(sizes, counts, budget)
        assert all(0 <= t <= n for t, n in zip(got, counts))
        # No other choice beyond the proportional part comes nearer from below.
        base = [n * budget // sum(s * m for s, m in zip(sizes, counts)) for n in counts]
        sums = {0}
        for s, n, b in zip(sizes, counts, base):
            sums = {x + s * k for x in sums for k in range(n - b + 1)}
        left = budget - sum(s * b for s, b in zip(sizes, base))
        assert sum(s * t for s, t in zip(sizes, got)) == budget - left + max(x for x in sums if x <= left)


def test_many_steps_are_traced_back(monkeypatch):
    monkeypatch.setattr(mixing, "HELD_STEPS", 3)
    sizes, counts = list(range(2, 200, 2)), [5] * 99
    got = mixing.fit(sizes, counts, 9_999)
    assert sum(s * t for s, t in zip(sizes, got)) == 9_998 and max(got) <= 5


def test_capital_sigma_parts_no_window(spark):
    greek = "ΛΟΓΟΣ:ΑΡΧΗ ΕΝ ΤΩ ΚΟΣΜΩ ΗΝ ΠΡΟΣ ΤΟΝ ΘΕΟΝ ΚΑΙ"
    docs = spark.createDataFrame([(1, greek.replace(":", " ")), (2, "x " + greek)], "doc_id long, text string")
    items = spark.createDataFrame([("i", greek)], "item_id string, text string")
    got = {r.doc_id: r.n_hit for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: 10, 2: 10}


def test_what_is_broadcast_is_measured_in_bytes(spark):
    wide = stored(spark.range(100).selectExpr("id", "repeat(cast(id as string), 1000) as text"), "wide")
    assert "broadcast" in small(wide)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in small(wide, size=10)._jdf.queryExecution().logical().toString().lower()
