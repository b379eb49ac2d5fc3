"""The curve of the language model is learned from every text, not from a part of them."""

from __future__ import annotations

import numpy as np

from tallyhouse.llm import lang_id


def test_every_text_is_judged_by_a_model_that_has_not_counted_it(spark, monkeypatch):
    words = {"en": "the thing gathers other", "de": "schnee und straße nicht"}
    rows = [(i, f"{words[('en', 'de')[i % 2]]} {i * 7919}", ("en", "de")[i % 2]) for i in range(6_000)]
    seen = []
    curve = lang_id._curve
    monkeypatch.setattr(lang_id, "_curve", lambda judged: seen.append(judged.count()) or curve(judged))
    model = lang_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert seen == [6_000]  # about 600 of them before
    assert model.curve.least == 0.0 and model.curve.ceiling < 20


def test_bounds_are_those_of_a_plain_count_over_all_rows(spark):
    rng = np.random.default_rng(4)
    score = np.round(rng.random(5_000), 3)  # many equal scores
    named = rng.random(5_000) < np.where(score > 0.4, 0.9995, 0.6)
    own = rng.random(5_000)
    n = len(lang_id.SHARPNESS)
    rows = [([-9 * (i != 2) for i in range(n)], [float(s) * (i == 2) for i in range(n)], bool(k), float(o)) for s, k, o in zip(score, named, own)]
    judged = spark.createDataFrame(rows, "logs array<long>, scores array<double>, named boolean, own double").repartition(7)
    curve = lang_id._curve(judged)
    good = [s for s in np.unique(score) if named[score >= s].sum() * 1000 >= 995 * (score >= s).sum()]
    assert curve.sharpness == lang_id.SHARPNESS[2] and 0 < curve.least == min(good)
    assert curve.ceiling == 1.1 * own[named].max()
    assert lang_id._curve(judged.limit(0)) is None
