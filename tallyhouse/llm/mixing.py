"""Mixing sources to target weights by fitting a subset sum of document lengths.

Documents are counted by source and exact length. Each source takes whole passes over
itself, then a part of each length in proportion; what remains of its budget is met by
a bounded-knapsack dynamic programme over the lengths that are left. Which documents of
a length are taken is decided by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import scratch, stored
from tallyhouse.operators.ranking import global_rank
from tallyhouse.sources.tables import TableFolder

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
PASSES = 3  # no document is taken more often
SEED = 20_240_611
# Words that the dynamic programme has to meet at least; twice the longest document if that
# is more, so that documents of every length are fitted. Whole documents fill the rest.
DP_WORDS = 1 << 16
# Steps of the programme between two sets of sums that are held.
HELD_STEPS = 64


def _targets(sizes: DataFrame, weights: tuple[int, ...], passes: int) -> DataFrame:
    """source, source_size, target: shares by weight, stopped at ``passes`` sizes.

    What stopped sources leave is shared again by weight among the others, until no
    target is above its stop. Each round is one sum over one row per source; a source
    that is stopped stays so, so the rounds end.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ranked = global_rank(
        totals, [F.col("source").asc_nulls_last()], TableFolder(spark, scratch(spark, "sources")), "ranked"
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = stored(ranked.select("source", "source_size", weight.alias("weight")), "totals")
    stop = F.col("source_size") * passes
    level, stopped = 0.0, -1
    while True:
        free = ~(stop < F.lit(level) * F.col("weight"))
        row = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0)).alias("weight"),
            F.coalesce(F.sum(F.when(~free, stop)), F.lit(0)).alias("used"),
            F.count(F.when(~free, 1)).alias("stopped"),
        ).first()
        if row["stopped"] == stopped or not row["weight"]:
            break
        level, stopped = (row["all"] - row["used"]) / row["weight"], row["stopped"]
    target = F.least(stop.cast("double"), F.lit(float(level)) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def fit(sizes: list[int], counts: list[int], budget: int, dp_words: int = DP_WORDS) -> list[int]:
    """How many documents of each size to take, so that the words come to ``budget``.

    A proportional part of each size is taken first. The rest is filled one document
    per size, those nearest to their next whole number first, then by large sizes down
    to ``dp_words`` or twice the longest document; the last words are a bounded knapsack,
    solved exactly by a set of reachable sums held as the bits of one integer. Sets are
    held for every ``HELD_STEPS``-th step, those between are made again on the way back.
    """
    dp_words = max(dp_words, 2 * max(sizes, default=0))
    total = sum(s * n for s, n in zip(sizes, counts))
    if budget <= 0 or total <= 0:
        return [0] * len(sizes)
    if budget >= total:
        return [n if s else 0 for s, n in zip(sizes, counts)]
    taken, part = [], []
    for s, n in zip(sizes, counts):
        whole, rest = divmod(n * budget, total) if s else (0, 0)
        taken.append(whole)
        part.append(rest)
    left = budget - sum(s * t for s, t in zip(sizes, taken))
    for i in sorted(range(len(sizes)), key=lambda i: (-part[i], -sizes[i])):
        if left <= dp_words:
            break
        if sizes[i] and taken[i] < counts[i] and sizes[i] <= left - dp_words:
            taken[i] += 1
            left -= sizes[i]
    large_first = sorted((i for i in range(len(sizes)) if sizes[i]), key=lambda i: -sizes[i])
    for i in large_first:
        if left <= dp_words:
            break
        more = min(counts[i] - taken[i], left // sizes[i])
        taken[i] += more
        left -= more * sizes[i]
    mask, reach, steps, held = (1 << (left + 1)) - 1, 1, [], []
    for i in large_first:
        spare, chunk = min(counts[i] - taken[i], left // sizes[i]), 1
        while spare > 0 and not reach >> left & 1:
            use = min(chunk, spare)
            if len(steps) % HELD_STEPS == 0:
                held.append(reach)
            steps.append((i, use))
            reach |= reach << use * sizes[i] & mask
            spare, chunk = spare - use, chunk * 2
    at = reach.bit_length() - 1
    while held:
        before, block = [held.pop()], steps[len(held) * HELD_STEPS :]
        del steps[len(held) * HELD_STEPS :]
        for i, use in block:
            before.append(before[-1] | before[-1] << use * sizes[i] & mask)
        for (i, use), sums in zip(reversed(block), reversed(before[:-1])):
            if not sums >> at & 1:
                taken[i] += use
                at -= use * sizes[i]
    return taken


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """For one source: passes over every document, and the documents per length beyond."""
    size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    passes = min(int(target // size), PASSES) if size else 0
    budget = 0 if passes == PASSES else int(round(target - passes * size))
    rows = rows.sort_values("size")
    quota = fit(rows["size"].tolist(), rows["n"].tolist(), budget)
    return rows.assign(passes=np.int64(passes), quota=np.array(quota, dtype=np.int64))[
        ["source", "size", "n", "source_size", "target", "passes", "quota"]
    ]


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken.

    A null text has size 0 and is taken 0 times; a null source is a source, the last
    in order. Rows with equal doc_id are separate documents that may be taken apart;
    which of two equal ones is, makes no difference. An empty table gives no rows.

    One row per source and length goes through the planning of a source, never its
    documents. To choose among the documents of a length they are dealt by hash into
    about sqrt(n) parts: parts are taken whole in order, and only inside a part rows
    are numbered, so a length that holds a third of all documents is no single task.
    """
    sized = stored(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sized",
    )
    counts = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    targets = _targets(counts, weights, PASSES)
    known = counts.join(targets, counts["source"].eqNullSafe(targets["source"])).select(
        counts["*"], "source_size", "target"
    )
    schema = "source string, size long, n long, source_size long, target double, passes long, quota long"
    plan = stored(known.groupBy("source").applyInPandas(_plan, schema), "plan")

    joined = sized.join(
        plan, sized["source"].eqNullSafe(plan["source"]) & (sized["size"] == plan["size"])
    ).select(sized["*"], "n", "source_size", "target", "passes", "quota")
    joined = joined.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id"))
    parts = F.when(F.col("n") > 1024, F.ceil(F.sqrt("n"))).otherwise(F.lit(1)).cast("long")
    joined = stored(joined.withColumn("_part", F.pmod("_hash", parts)), "dealt")
    per_part = joined.groupBy("source", "size", "_part").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.partitionBy("source", "size").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    per_part = per_part.withColumn("_before", F.sum("_m").over(before) - F.col("_m")).drop("_m")
    dealt = joined.join(
        per_part,
        joined["source"].eqNullSafe(per_part["source"])
        & (joined["size"] == per_part["size"])
        & (joined["_part"] == per_part["_part"]),
    ).select(joined["*"], "_before")
    place = F.row_number().over(
        Window.partitionBy("source", "size", "_part").orderBy("_hash", "doc_id")
    )
    chosen = (F.col("_before") + place <= F.col("quota")).cast("long")
    return dealt.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("passes") + chosen)).alias("taken"),
    )
