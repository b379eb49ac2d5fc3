"""The text operators against brute force and SQL, with the awkward rows each must take."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest

import __spark_entry__ as contract
from tallyhouse.llm import (
    decontaminate,
    embed_dedup,
    html_wrapper,
    jaccard,
    lang_id,
    line_dedup,
    mixing,
    passages,
    toxicity,
    url_filter,
)
from tallyhouse.llm.components import components
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _text string, n long, key string"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), "x", 7, None) for i, t, lang, s in rows], DOCS
    )


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, nulls, blanks, a long text and a repeated row."""
    rng = random.Random(4)
    base, passage = words(rng, 160), words(rng, 70)
    rows = [(1, " ".join(base), "en", "a"), (2, " ".join(base).upper(), "en", "a")]
    for i in range(3, 9):
        near = list(base)
        near[rng.randrange(160)] = f"new{i}"
        rows.append((i, " ".join(near), "en", "a"))
    far = list(base)
    for p in range(0, 160, 8):
        far[p] = f"far{p}"
    rows.append((9, " ".join(far), "en", "b"))
    for i in (10, 11):
        rows.append((i, " ".join(words(rng, 60) + passage + words(rng, 50)), "en", "b"))
    fuzzy = list(passage)
    fuzzy[30] = "changed"
    rows.append((12, " ".join(words(rng, 40) + fuzzy + words(rng, 90)), "en", None))
    rows.append((13, " ".join(words(rng, 20_000)), "en", None))
    rows += [(14, None, None, "c"), (15, "", "en", "c"), (16, " \t\n ", None, "c"), (17, "One", "en", "c")]
    rows += [(18, "one", "en", "c"), (18, "one", "en", "c"), (None, "no id but words enough here", "en", "d")]
    rows += [(20, "one two", "en", "d"), (21, "a b c", "en", "d"), (22, "A b C", "en", "d")]
    return rows


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", ["op2_decontaminate", "op8_line_dedup"])
def test_same_rows_as_sql(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    assert compare(df, connect(FOLDER), contract.oracle_sql()[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_every_text_query_is_registered():
    names = set(contract.queries())
    assert "pipeline" in names
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 11))


# 1 -------------------------------------------------------------------------------------------------

PAGE = (
    "<!DOCTYPE html><html><head><title>no</title><script>var t='</p>';</script></head><body>"
    "<nav><ul><li><a href='/x'>menu</a></li><li><a>two</a></li></ul></nav><!-- note -->"
    "<div class=\"ad\">buy {0}</div><div class='cookie-notice'>we use cookies</div>"
    "<article><h1>Title {0}</h1><p>First&nbsp;&amp; <b>bo</b>ld {0}<br>line<p>Second   {0}&#33;</p>"
    "<aside>see also</aside><form>mail <input name=a></form>{1}</article>"
    "<section class=comments><p>I liked {0}</p></section><footer>&copy; {0}</footer>"
)


def test_html_keeps_the_article_only(spark):
    rows = [(i, f"http://host.example/{i}", PAGE.format(i, "<p>more</p>" * (i % 3))) for i in range(8)]
    rows += [(20, None, None), (21, "http://host.example/e", ""), (22, "no url", "<p>alone<p>two")]
    rows += [(23, "http://other.example/", "plain words &lt; only"), (0, *rows[0][1:])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as path")
    got = {r.page_id: r.text for r in html_wrapper.main_text(pages).collect()}
    for i in range(8):
        assert got[i] == " ".join([f"Title {i} First & bold {i} line Second {i}!", *["more"] * (i % 3)])
    assert (got[20], got[21], got[22], got[23]) == ("", "", "alone two", "plain words < only")
    assert html_wrapper.main_text(pages.limit(0)).count() == 0


def test_wrapper_has_slots_repeats_and_options():
    wrapper = html_wrapper.infer([PAGE.format(i, "<p>more</p>" if i else "<table></table>") for i in range(3)])
    written = html_wrapper.expression(wrapper)
    assert "(<li>" in written and ")+" in written and "#slot" in written and ")?" in written
    assert html_wrapper.article_path(wrapper) == ["html", "body", "article"]


# 2 -------------------------------------------------------------------------------------------------


def contaminated(docs, items, span=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    out = {}
    for doc, text in docs:
        own, hit, found = split(text), set(), set()
        for item, sample in items:
            theirs = split(sample)
            n = min(span, len(theirs))
            for j in range(len(theirs) - n + 1 if n else 0):
                for i in range(len(own) - n + 1):
                    if own[i : i + n] == theirs[j : j + n]:
                        hit.update(range(i, i + n))
                        if item is not None:
                            found.add(str(item))
        ids = ",".join(sorted(found))
        out[doc] = (len(own), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_decontamination_is_exact(spark, broadcast_rows):
    rng = random.Random(2)
    long = words(rng, 30)
    items = [(1, " ".join(long)), (10, " ".join(long)), (2, "Short One"), (3, None), (4, "é!"), (5, ""), (None, " ".join(long[5:20]))]
    docs = [(1, " ".join(words(rng, 5) + long[3:15] + words(rng, 5))), (2, " ".join(long[:9])), (3, "a SHORT, one b")]
    docs += [(4, None), (5, ""), (6, "É é"), (7, " ".join(long + long).upper()), (8, "clean text of words")]
    frame_of = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words", "'x' as fp")
    bench = spark.createDataFrame(items, "item_id int, text string").selectExpr("*", "'x' as item")
    got = decontaminate.decontaminate(frame_of, bench, broadcast_rows=broadcast_rows).collect()
    expected = contaminated(docs, items)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == expected
    clean = decontaminate.clean_documents(frame_of, bench)
    assert clean.columns == frame_of.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, v in expected.items() if not v[4]}
    if broadcast_rows:
        nothing = decontaminate.decontaminate(frame_of, bench.limit(0))
        assert not any(r.contaminated for r in nothing.collect())
        assert decontaminate.decontaminate(frame_of.limit(0), bench).count() == 0


# 3 -------------------------------------------------------------------------------------------------


def test_language_is_found_on_held_out_texts(spark):
    rng = random.Random(3)
    syllables = {"en": ["th", "ing", "er", "on"], "de": ["sch", "ung", "ei", "ß"], "fr": ["eau", "é", "ç", "oi"]}
    rows = []
    for i in range(120):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(30)), lang, "a"))
    rows += [(200, None, "en", "a"), (201, "", "en", "a"), (202, "123 !?", "de", "a"), (203, rows[0][1] * 400, None, "a")]
    docs = frame(spark, rows)
    model = lang_id.train(docs.filter("crc32(cast(doc_id as string)) % 5 != 0"))
    got = {r.doc_id: r for r in lang_id.identify(docs, model).collect()}
    assert all(got[i].lang_pred == rows[i][2] and 0 <= got[i].score <= 1 for i in range(120))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(120))
    assert [got[i].lang_pred for i in (200, 201, 202, 203)] == ["und", "und", "und", "en"]
    refused = lang_id.identify(docs.filter("doc_id = 0"), model, least=1.1).first()
    assert refused.lang_pred == "und"
    assert lang_id.train(docs.limit(0)) is None
    assert {r.lang_pred for r in lang_id.identify(docs, None).collect()} == {"und"}


def test_kneser_ney_shares_sum_to_one(spark):
    docs = frame(spark, [(1, "abab abba baab " * 20, "x", "a"), (2, "cdcd dccd " * 20, "y", "a")])
    model = lang_id.train(docs)
    letters = [1] + [ord(c) for c in "abcd"] + [0]
    context = (ord("a") << 32) | (ord("b") << 16)
    codes = np.array([1 << 48 | context | c for c in letters], dtype=np.uint64)
    total = model.entries.probabilities(codes)[:, 0].sum()
    assert 0.99 < total <= 1.001


def plain_kneser_ney(texts: list[str], discount: float = 0.75):
    """Cross-entropy of a text by tuples and dictionaries, one character at a time."""

    def symbols(text):
        out = []
        for c in text.lower():
            c = c if c.isalpha() else " "
            if not (c == " " and out and out[-1] == " "):
                out.append(c)
        return [None] * 3 + out

    counts = {4: Counter(), 3: Counter(), 2: Counter(), 1: Counter()}
    for text in texts:
        seen = symbols(text)
        counts[4].update(tuple(seen[i : i + 4]) for i in range(len(seen) - 3))
    for k in (3, 2, 1):
        for longer in counts[k + 1]:
            counts[k][longer[1:]] += 1

    def share(gram):
        if not gram:
            return 1 / 65536
        after = {g: n for g, n in counts[len(gram)].items() if g[:-1] == gram[:-1]}
        if not after:
            return share(gram[1:])
        total = sum(after.values())
        return max(after.get(gram, 0) - discount, 0) / total + discount * len(after) / total * share(gram[1:])

    def entropy(text):
        seen = symbols(text)
        return -sum(math.log(share(tuple(seen[i : i + 4]))) for i in range(len(seen) - 3)) / (len(seen) - 3)

    return entropy


SENTENCES = {
    "en": ["the thing, there; THE other", "this is 42 things", "they gather here"],
    "de": ["der Schnee schmilzt schön", "die Straße ist naß 7"],
    "ja": ["日本語の文字である", "文字と言葉 𠀀𠀁"],
}


def test_cross_entropies_are_those_of_a_plain_kneser_ney(spark):
    rows = [(i * 10 + j, t, lang, "a") for i, (lang, own) in enumerate(SENTENCES.items()) for j, t in enumerate(own)]
    model = lang_id.train(frame(spark, rows))
    tried = ["the other thing", "Schnee 12 THE", "日本の言葉", "zzz", "Ω ß", rows[0][1] * 50]
    got, letters = model.entries.entropies(tried)
    assert letters.all()
    for i, lang in enumerate(model.langs):
        entropy = plain_kneser_ney(SENTENCES[lang])
        np.testing.assert_allclose(got[:, i], [entropy(t) for t in tried], rtol=1e-9)


def test_a_model_kept_as_a_table_gives_the_same_names(spark, monkeypatch):
    rng = random.Random(9)
    langs = [f"l{i:02d}" for i in range(40)]
    rows = []
    for i in range(200):
        own = random.Random(i % 40).sample("abcdefghijklmnopqrstuvwxyz", 6)
        rows.append((i, " ".join("".join(rng.choices(own, k=5)) for _ in range(8)), langs[i % 40], "a"))
    rows += [(300, None, "l00", "a"), (301, "", "l01", "a"), (302, "123", None, "a"), rows[0], rows[0]]
    rows.append((303, rows[1][1] * 500, None, "a"))
    docs = frame(spark, rows)
    few, many = lang_id.train(docs), lang_id.train(docs, model_bytes=0)
    assert few.entries is not None and many.entries is None
    assert few.curve == many.curve
    monkeypatch.setattr(lang_id, "SLICE_CHARS", 4_000)
    one, other = (sorted(lang_id.identify(docs, m).collect()) for m in (few, many))
    assert len(one) == len(rows)
    assert [r[:3] for r in one] == [r[:3] for r in other]
    np.testing.assert_allclose([r.score for r in one], [r.score for r in other], rtol=1e-9)
    assert lang_id.identify(docs.limit(0), many).count() == 0
    assert lang_id.identify(docs.filter("doc_id = 300"), many).first().lang_pred == "und"


def test_what_is_unlike_all_learned_languages_is_rejected(spark):
    rng = random.Random(5)
    words = {"en": ["the", "thing", "other", "gather", "there"], "de": ["schnee", "straße", "und", "nicht", "eis"]}
    rows = [
        (i, " ".join(rng.choices(words[lang], k=40)), lang, "a") for i in range(300) for lang in [("en", "de")[i % 2]]
    ]
    docs = frame(spark, [*rows, (900, "qxzv jjkq wvvx zzqj xkcd " * 20, None, "a"), (901, None, None, "a")])
    got = {r.doc_id: r for r in lang_id.identify(docs, lang_id.train(docs)).collect()}
    assert got[900].rejected and got[900].lang_pred in ("en", "de") and got[901].rejected
    assert sum(got[i].rejected for i in range(300)) <= 3


# 4 -------------------------------------------------------------------------------------------------


def test_url_rules_and_model(spark):
    rows = [
        (1, "http://a.example.net/en/1?x=/de/", "example.net/en/", "allow"),
        (2, "http://example.NET/fr/", "net/", "block"),
        (3, "https://www.example.com/de/1#f", "example.com/de/", "block"),
        (4, "https://x.org/fr/", "org/fr/", "allow"),
        (5, "https://example.net", None, None),
        (6, None, None, None),
        (7, "no scheme", None, None),
        (8, "http://notexample.com/de/1", None, None),
        (9, "http://www.cheap-pills.example.com/en/1", None, "block"),
        (10, "http://blog.theres.example.com/en/5", None, "allow"),
        (10, "http://blog.theres.example.com/en/5", None, "allow"),
    ]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule")
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    for i, _, rule, verdict in rows:
        assert got[i].rule == rule and (verdict is None or got[i].verdict == verdict)
    assert (got[1].host, got[1].path) == ("a.example.net", "/en/1") and (got[6].host, got[7].path) == ("", "")
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


# 5 -------------------------------------------------------------------------------------------------


def test_passages_of_different_documents_are_found(spark, corpus):
    got = passages.shared_passages(frame(spark, corpus)).collect()
    pairs = {(r.doc_id, r.ref_doc_id) for r in got}
    assert {(i, 1) for i in range(2, 9)} <= pairs and (11, 10) in pairs and (12, 10) in pairs
    assert {d for p in pairs for d in p} <= set(range(1, 13))
    exact = next(r for r in got if (r.doc_id, r.ref_doc_id) == (11, 10))
    assert (exact.start_word, exact.end_word, exact.n_matched) == (60, 130, 70)
    assert passages.shared_passages(frame(spark, corpus).limit(0)).count() == 0


def test_passages_around_different_text_are_found(spark):
    rng = random.Random(51)
    head, foot, middle = words(rng, 60), words(rng, 60), words(rng, 60)
    for gaps in ((60, 60), (31, 31), (200, 200), (0, 90)):
        a, b = (words(rng, 20) + head + words(rng, n) + foot + words(rng, 20) for n in gaps)
        got = passages.shared_passages(frame(spark, [(1, " ".join(a), "en", "a"), (2, " ".join(b), "en", "a")]))
        at = {(r.start_word, r.end_word, r.ref_start_word, r.ref_end_word) for r in got.collect()}
        assert at == {(20, 80, 20, 80), (80 + gaps[1], 140 + gaps[1], 80 + gaps[0], 140 + gaps[0])}
    # Sixty words in common, then sixty in which seeds survive but every second word group differs.
    poor = [w if p % 12 < 7 else f"x{p}" for p, w in enumerate(middle)]
    texts = [(1, " ".join(head + middle), "en", "a"), (2, " ".join(head + poor), "en", "a")]
    spans = [(r.start_word, r.end_word) for r in passages.shared_passages(frame(spark, texts)).collect()]
    assert spans and spans[0][0] == 0 and spans[0][1] >= 60


def test_a_passage_that_earlier_documents_hold_in_part_is_found(spark):
    rng = random.Random(52)
    passage = words(rng, 60)

    def around(part):
        return " ".join(words(rng, 15) + part + words(rng, 15))

    texts = [passage[:42], passage[18:], passage, passage[:45], passage[16:], passage]
    rows = [(i, around(t), "en", "a") for i, t in enumerate(texts, 1)]
    # The first place in document 20 holds the beginning only.
    other = words(rng, 60)
    rows += [(20, around(other[:40] + words(rng, 400) + other[25:] + words(rng, 400) + other), "en", "a")]
    rows += [(21, around(other), "en", "a")]
    got = passages.shared_passages(frame(spark, rows)).collect()
    at = {(r.doc_id, r.start_word, r.end_word, r.ref_doc_id, r.ref_start_word, r.n_matched) for r in got}
    assert {(6, 15, 75, 3, 15, 60), (21, 15, 75, 20, 15 + 40 + 400 + 35 + 400, 60)} <= at


@pytest.mark.parametrize("copies", [1, 12])
def test_a_fuzzy_passage_that_earlier_documents_hold_in_part_is_found(spark, copies):
    rng = random.Random(54)
    rows, planted = [], {}
    for _ in range(6):
        passage = words(rng, 66)
        # Every seed that the last two have in common first occurs in a document with less than a passage.
        texts = [passage[:38], passage[28:]] * copies
        for changed in (20, 45):
            texts.append([w if p != changed else f"new{changed}" for p, w in enumerate(passage)])
        for t in texts:
            rows.append((len(rows), " ".join(words(rng, 30) + t + words(rng, 30)), "en", "a"))
        planted[len(rows) - 1] = len(rows) - 2
    got = passages.shared_passages(frame(spark, rows)).collect()
    found = {r.doc_id for r in got if planted.get(r.doc_id) == r.ref_doc_id and r.n_matched >= 60}
    assert found == set(planted)


def test_words_that_repeat_give_few_passages(spark):
    rng = random.Random(55)
    same = ["again"] * 1000
    rows = [(i, " ".join(words(rng, 30) + same + words(rng, 30)), "en", "a") for i in (1, 2)]
    got = passages.shared_passages(frame(spark, rows)).collect()
    assert len(got) < 60 and {p for r in got for p in range(r.start_word, r.end_word)} >= set(range(30, 1030))


def test_recall_of_fuzzy_passages(spark):
    rng = random.Random(53)
    rows, planted = [], {}
    for share in (0.95, 0.9, 0.85, 0.8):
        for _ in range(60):
            passage, a, b = words(rng, 60), len(rows), len(rows) + 1
            changed = list(passage)
            for p in rng.sample(range(60), round(60 * (1 - share))):
                changed[p] = words(rng, 1)[0] + "zz"
            # By brute force the pair shares a passage: the planted one, word by word.
            assert sum(v == w for v, w in zip(passage, changed)) >= share * 60
            for i, own in ((a, passage), (b, changed)):
                rows.append((i, " ".join(words(rng, 30) + own + words(rng, 30)), "en", "a"))
            planted[b] = share
    got = {r.doc_id for r in passages.shared_passages(frame(spark, rows)).collect() if r.ref_doc_id == r.doc_id - 1}
    recall = {s: sum(b in got for b, t in planted.items() if t == s) / 60 for s in set(planted.values())}
    assert recall[0.95] == 1.0 and recall[0.9] >= 0.98 and recall[0.85] >= 0.95 and recall[0.8] >= 0.9, recall


def test_chains_against_brute_force():
    rng = random.Random(5)
    for _ in range(40):
        pairs = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(9)})
        best = 0.0
        for n in range(1, len(pairs) + 1):
            for some in combinations(pairs, n):
                steps = list(zip(some, some[1:]))
                if all(b[0] > a[0] and b[1] > a[1] for a, b in steps):
                    best = max(best, n - sum(b[0] - a[0] + b[1] - a[1] for a, b in steps) * passages.GAP)
        found = passages.chains(pairs, k=0)
        score = max((n - (x1 - x0 + y1 - y0) * passages.GAP for x0, x1, y0, y1, n in found), default=1.0)
        assert score == pytest.approx(best) or best <= 1.0


# 6 -------------------------------------------------------------------------------------------------


def test_toxicity_is_learned_and_folded(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(300):
        own = words(rng, 40)
        if i % 5 == 0:
            own[rng.randrange(40)] = rng.choice(["moron", "zxqv" + words(rng, 1)[0], "trash"])
        rows.append((i, " ".join(own), "en", "a"))
        labels.append((i, int(i % 5 == 0)))
    labels += [(None, 1), (5, None), (6, 7), (9999, 1)]
    extra = {400: "you m0r0n there", 401: "the trash can stood there", 402: None, 403: "", 404: "ＭＯＲＯＮ", 405: "mоron " + "word " * 5000}
    docs = frame(spark, rows + [(i, t, None, None) for i, t in extra.items()])
    lexicon = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, lexicon).collect()}
    assert sum(got[i].predicted == int(i % 5 == 0) for i in range(300)) >= 295
    assert [got[i].predicted for i in (400, 401, 402, 403, 404)] == [1, 0, 0, 0, 1]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    kept = toxicity.not_toxic(docs, lexicon)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got.values())
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(docs, none).collect()} == {0}


# 7 -------------------------------------------------------------------------------------------------


def shingle_components(rows, k, percent):
    sets = {}
    for doc, text, *_ in rows:
        if doc is not None:
            own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
            sets[doc] = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if len(own) >= k else {tuple(own)} - {()}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components_are_exact(spark, corpus, k, percent):
    rng = random.Random(k)
    base = words(rng, 120)
    rows = list(corpus)
    for i in range(100, 150):  # a drifting family: neighbours link, the ends do not
        base[rng.randrange(120)] = f"w{i}"
        rows.append((i, " ".join(base), "en", "a"))
    got = jaccard.jaccard_components(frame(spark, rows), k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == shingle_components(rows, k, percent)
    assert len(got) == len(rows) and [r.component_id for r in got if r.doc_id is None] == [None]
    if k == 5:
        left = jaccard.one_of_each(frame(spark, rows))
        want = {d for d, (_, c) in shingle_components(rows, 5, 80).items() if c == d} | {None}
        assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(map(str, want))
        assert jaccard.jaccard_components(frame(spark, rows).limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


# 8 -------------------------------------------------------------------------------------------------


def test_later_lines_go(spark):
    rows = [(2, "x\na\nb\nc\ny", "en", "s"), (1, "a\nb\nc\nd", "en", "s"), (3, None, "en", "s"), (4, "", "en", "s")]
    rows += [(5, "b\nc\nd", "en", "s"), (6, "L\n" * 5 + "end", "en", "s"), (7, "\n\n\n\n", "en", "s"), (8, "a\nb", "en", "s")]
    rows += [(None, "q\nr\ns", "en", "s"), (9, "q\nr\ns\nt", "en", "s"), (10, "u\nv\nw", "en", "s"), (10, "u\nv\nw", "en", "s")]
    got = {}
    for r in line_dedup.dedup_lines(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, (r.n_lines, r.n_removed, r.text))
    assert got[1] == (4, 0, "a\nb\nc\nd") and got[2] == (5, 3, "x\ny") and got[5] == (3, 3, "")
    assert got[3] == (0, 0, None) and got[4] == (1, 0, "") and got[6] == (6, 4, "L\nend")
    assert got[7][1] == 0 and got[8][1] == 0 and got[9] == (4, 3, "t") and got[10][1] == 0
    left = line_dedup.without_repeated_lines(frame(spark, rows))
    assert left.schema == frame(spark, rows).schema
    kept = {r.doc_id: r for r in left.collect()}
    assert 5 not in kept and kept[2].n_chars == 3 and kept[3].text is None and left.count() == 11
    assert line_dedup.dedup_lines(frame(spark, rows).limit(0)).count() == 0


# 9 -------------------------------------------------------------------------------------------------


def test_embedding_links_reach_the_wanted_recall(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(300, 32))
    close = base[:150] + rng.normal(size=(150, 32)) * np.linspace(0.05, 0.55, 150)[:, None]
    big = base[200] + rng.normal(size=(600, 32)) * 0.15
    x = np.concatenate([base, close, big, base[:5]])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    truth = unit @ unit.T >= 0.9
    np.fill_diagonal(truth, False)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 32), (5003, [float("nan")] * 32), (5004, [None, 1.0]), (5005, [1.0]), (None, x[0].tolist())]
    df = spark.createDataFrame(rows + [(i, v, 0) for i, v in odd], "vec_id long, embedding array<double>, rep int")
    got = {r.vec_id: r for r in embed_dedup.link_embeddings(df).collect()}
    found = sum(got[i].n_links for i in range(len(x)))
    assert 0.9 * truth.sum() <= found <= truth.sum()
    assert all(got[i].n_links <= truth[i].sum() for i in range(len(x)))
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(5000, 5006))
    assert got[None].component_id is None and not got[None].kept and got[1050].component_id == 0
    assert all(got[i].kept == (got[i].component_id == i) for i in got if i is not None)
    assert embed_dedup.link_embeddings(df.limit(0)).count() == 0


def test_embedding_recall_holds_with_many_pivots(spark):
    rng = np.random.default_rng(91)
    x = rng.normal(size=(2500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    both = np.concatenate([x, 0.902 * x + (1 - 0.902**2) ** 0.5 * y])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")
    got = embed_dedup.link_embeddings(df, bounds=(2048, 4096)).agg({"n_links": "sum"}).first()[0]
    truth = int((both @ both.T >= 0.9).sum()) - len(both)
    assert 0.95 * truth <= got <= truth


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
@pytest.mark.parametrize("bounds", [embed_dedup.PIVOTS, (1024, 4096)])
def test_embedding_recall_on_the_whole_table(spark, bounds):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    x = np.array([r.embedding for r in df.select("embedding").collect()], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    truth = int((x @ x.T >= 0.9).sum()) - len(x)
    got = embed_dedup.link_embeddings(df, bounds=bounds).agg({"n_links": "sum"}).first()[0]
    assert 0.95 * truth <= got <= truth


# 10 ------------------------------------------------------------------------------------------------


def test_budget_is_met_like_brute_force():
    rng = random.Random(10)
    for _ in range(200):
        sizes = rng.sample(range(0, 40), 6)
        counts = [rng.randint(1, 3) for _ in sizes]
        budget = rng.randint(0, sum(s * n for s, n in zip(sizes, counts)))
        taken = mixing.fit(sizes, counts, budget, dp_words=1000)
        assert all(0 <= t <= n for t, n in zip(taken, counts))
        base = [n * budget // max(1, sum(s * m for s, m in zip(sizes, counts))) if s else 0 for s, n in zip(sizes, counts)]
        sums = {sum(s * b for s, b in zip(sizes, base))}
        for s, n, b in zip(sizes, counts, base):
            sums = {a + s * j for a in sums for j in range(n - b + 1)}
        assert sum(s * t for s, t in zip(sizes, taken)) == max(v for v in sums if v <= budget)


def test_mix_meets_its_targets(spark, corpus):
    rng = random.Random(11)
    rows = list(corpus) + [(1000 + i, "same words here", "en", "big") for i in range(1500)]
    rows += [(3000 + i, " ".join(words(rng, rng.randint(1, 50))), "en", rng.choice("abz")) for i in range(200)]
    docs = frame(spark, rows)
    got, again = (sorted(map(tuple, mixing.mix(docs).collect()), key=str) for _ in range(2))
    assert got == again and len(got) == len(rows)
    sizes: dict = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, target, open_ = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, {}, set(order)
    left = sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
        open_ -= over
    target |= {s: weight[s] * level for s in open_}
    by_id = {(i, t): s for i, t, _, s in rows}
    text_of = {i: t for i, t, _, _ in rows}
    taken: dict = {}
    for doc, size, source_size, wanted, words_taken in got:
        source = by_id[(doc, text_of[doc])]
        assert source_size == sizes[source] and wanted == pytest.approx(target[source])
        assert 0 <= words_taken <= 3 * size and (size == 0 or words_taken % size == 0)
        taken[source] = taken.get(source, 0) + words_taken
    # Documents are taken whole: no source can be asked to be nearer than its largest one.
    largest = {s: max(size for doc, size, *_ in got if by_id[(doc, text_of[doc])] == s) for s in order}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in order)
    assert all(abs(taken[s] - target[s]) <= 3 for s in ("big", "z"))
    assert mixing.mix(docs.limit(0)).count() == 0
