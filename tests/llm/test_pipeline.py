"""Each stage of the pipeline against brute force on its own input."""

from __future__ import annotations

import random

import corpus_pipeline
from tests.llm.test_text_operators import DOCS, contaminated, frame, shingle_components, words


def test_stages_take_effect_one_after_the_other(spark, tmp_path):
    rng = random.Random(12)
    bench = " ".join(words(rng, 20))
    rows, labels = [], []
    for i in range(120):
        own = words(rng, 60)
        if i % 6 == 0:
            own[5] = "scum"
        rows.append([i, "\n".join(" ".join(own[j : j + 10]) for j in range(0, 60, 10)), "en", f"s{i % 4}"])
        labels.append((i, int(i % 6 == 0)))
    rows[50][1] = rows[49][1].replace("\n", " ")
    rows[61][1] = rows[59][1]
    rows[71][1] += " " + bench
    rows += [[200, None, None, None], [201, "", "en", "s1"]]
    frame(spark, rows).select(*[c.split()[0] for c in DOCS.split(", ")][:5]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("doc_id", "1 as quality", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights",
    ]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        kept.append({r.doc_id: r.text for r in out.collect()})
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert set(kept[0]) == {r[0] for r in rows} - set(range(0, 120, 6))
    assert set(kept[1]) == set(kept[0]) - {61}
    alone = {d for d, (_, c) in shingle_components(kept[1].items(), 5, 80).items() if c == d}
    assert set(kept[2]) == alone and 50 not in kept[2]
    clean = contaminated(kept[2].items(), [(1, bench)])
    assert set(kept[3]) == {d for d in kept[2] if not clean[d][4]} == set(kept[2]) - {71}
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in mixed} == set(kept[3]) and sum(r.taken for r in mixed) > 0
