"""Near-duplicate embeddings through a pivot-permutation index.

Reference vectors (pivots) are drawn from the data by hash, none close to another; there
are about sqrt(n) of them, so lists stay short as the data grows. Every vector is described by its nearest
pivots in order, and stands in the inverted list of each pair of them: two vectors in
one list share at least two pivots. Lists are cut into blocks and pairs of blocks are
compared by exact cosine, so a hot list is many tasks of bounded size. A pair that is
in several lists counts only in the first of those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored
from tallyhouse.llm.components import components

NEAREST = 6  # of 64 pivots; more of more pivots
PIVOTS = (64, 4096)  # bounds of the number of pivots; it is sqrt(n) between them
BLOCK = 256
SEED = 17


def _unit(batch_column) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for what links with nothing."""
    out = []
    for v in batch_column.to_pylist():
        if v is None or not v or any(x is None for x in v):
            out.append(None)
            continue
        a = np.array(v, dtype=np.float64)
        # Scaled first, so that squares neither overflow nor vanish.
        peak = np.abs(a).max() if np.isfinite(a).all() else 0.0
        if peak == 0.0:
            out.append(None)
            continue
        a = a / peak
        out.append(a / np.sqrt(a @ a))
    return out


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = _unit(batch.column("embedding"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array([None if u is None else u.tobytes() for u in units], pa.binary())],
            names=["vec_id", "unit"],
        )


def _matrix(column) -> np.ndarray:
    rows = [np.frombuffer(v.as_buffer(), dtype=np.float64) for v in column]
    return np.stack(rows) if rows else np.zeros((0, 0))


def _apart(drawn: np.ndarray, wanted: int) -> np.ndarray:
    """Pivots no two of which have a cosine of 0.5 or more, first drawn first.

    Several pivots inside one dense group would be nearest in a random order for each of
    its members, which would then share too few of them.
    """
    free, chosen = np.ones(len(drawn), dtype=bool), []
    for i in range(len(drawn)):
        if free[i] and len(chosen) < wanted:
            chosen.append(i)
            free &= drawn @ drawn[i] < 0.5
    return drawn[chosen]


def _nearest(pivots: int) -> int:
    """How many of the nearest pivots describe a vector.

    Two vectors at cosine 0.9 then share two with a probability of about 0.98, however
    many pivots there are; with six always it would fall to 0.81 at 4,096.
    """
    return NEAREST + max(0, int(np.ceil(np.log2(max(pivots, 1) / PIVOTS[0]) * 2 / 3)))


def link_embeddings(
    vectors: DataFrame, least: float = 0.9, nearest: int | None = None, bounds: tuple[int, int] = PIVOTS
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold a null or non-finite component link
    with nothing, nor do vectors of different length with each other, nor rows without
    vec_id, whose component is null and which are not kept. Equal vectors are one class
    in the index and are not compared with one another; each copy counts as a link.
    Rows with the same vec_id are one node; ``kept`` marks the smallest id of each
    component. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    units = stored(rows.mapInArrow(_valid, "vec_id long, unit binary"), "units")
    classes = stored(
        units.filter("vec_id is not null and unit is not null")
        .groupBy("unit")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
        "classes",
    )
    total = classes.count()
    wanted = int(min(bounds[1], max(bounds[0], round(total**0.5))))
    drawn = classes.orderBy(F.xxhash64(F.lit(SEED), "rep"), "rep").limit(4 * wanted).select("unit").toArrow()
    by_size: dict[int, np.ndarray] = {}
    for u in drawn.column("unit"):
        v = np.frombuffer(u.as_buffer(), dtype=np.float64)
        by_size.setdefault(len(v), []).append(v)
    pivots = spark.sparkContext.broadcast({n: _apart(np.stack(v), wanted) for n, v in by_size.items()})

    def describe(batches):
        for batch in batches:
            lists = []
            for u in batch.column("unit"):
                v = np.frombuffer(u.as_buffer(), dtype=np.float64)
                own = pivots.value.get(len(v))
                if own is None:
                    lists.append([0])
                    continue
                near = np.argsort(-(own @ v), kind="stable")[: nearest or _nearest(len(own))]
                lists.append(near.tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("copies"), batch.column("unit"), pa.array(lists, pa.list_(pa.int64()))],
                names=["rep", "copies", "unit", "near"],
            )

    described = stored(
        classes.select("rep", "copies", "unit").mapInArrow(describe, "rep long, copies long, unit binary, near array<long>"),
        "described",
    )
    # One key per pair of pivots; a single pivot (very small tables) is its own pair.
    pair_keys = F.flatten(
        F.transform(
            "near",
            lambda p: F.transform(F.filter("near", lambda q: (q > p) | (F.size("near") == 1)), lambda q: p * 65536 + q),
        )
    )
    size = F.octet_length("unit")
    members = described.select("rep", F.explode(pair_keys).alias("key"), size.alias("bytes"))
    lists = members.groupBy("key", "bytes").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    members = members.join(lists, ["key", "bytes"])
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    members = members.withColumn("_n", blocks).withColumn("_own", F.pmod(F.xxhash64("rep"), F.col("_n")).cast("int"))
    tiles = members.select(
        "rep", "key", "bytes", "_own",
        F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_other"),
    ).select("rep", "key", "bytes", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own")
    tiles = tiles.join(described, "rep")
    order = ["key", "bytes", "i", "j"]
    tiles = tiles.repartition(*order).sortWithinPartitions(*order)
    found = stored(tiles.mapInArrow(_compare(least), "rep long, links long, leader long"), "found")

    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = components(found.filter("leader != rep").select(F.col("rep").alias("a"), F.col("leader").alias("b")))
    of_class = classes.join(linked, "rep", "left").join(known, classes["rep"] == known["node"], "left").select(
        F.col("unit").alias("_unit"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "rep").alias("component"),
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return units.join(of_class, (units["unit"] == of_class["_unit"]) & units["vec_id"].isNotNull(), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _compare(least: float):
    """Links per vector and a forest of them, tile by tile, from rows sorted by tile."""

    def tile(table: pa.Table):
        rep, copies = (table.column(c).to_numpy() for c in ("rep", "copies"))
        block, near = table.column("_own").to_numpy(), table.column("near").to_pylist()
        key, i, j = (table.column(c)[0].as_py() for c in ("key", "i", "j"))
        x = _matrix(table.column("unit").combine_chunks())
        close = x @ x.T >= least
        np.fill_diagonal(close, False)
        if i != j:
            close &= block[:, None] != block[None, :]
        a, b = np.nonzero(np.triu(close))
        if len(a):
            width = max(map(len, near))
            lists = np.array([sorted(v) + [-1] * (width - len(v)) for v in near])
            shared = (lists[a][:, :, None] == lists[b][:, None, :]).any(2) & (lists[a] >= 0)
            first = shared.argmax(1)
            second = np.where(shared.sum(1) > 1, (shared & (shared.cumsum(1) == 2)).argmax(1), first)
            rows = np.arange(len(a))
            # Each pair counts in the smallest list it is in.
            ours = lists[a][rows, first] * 65536 + lists[a][rows, second] == key
            a, b = a[ours], b[ours]
        links = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
        leader = np.arange(len(rep))
        changed = True
        while changed and len(a):
            before = leader.copy()
            np.minimum.at(leader, a, leader[b])
            np.minimum.at(leader, b, leader[a])
            leader = leader[leader]
            changed = bool((before != leader).any())
        keep = np.flatnonzero(links > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(rep[keep]), pa.array(links[keep].astype(np.int64)), pa.array(rep[leader[keep]])],
            names=["rep", "links", "leader"],
        )

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            marks = np.stack([table.column(c).to_numpy() for c in ("key", "bytes", "i", "j")])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi - lo > 1:
                    yield tile(table.slice(lo, hi - lo))
            held = table.slice(cuts[-1])
        if held is not None and len(held) > 1:
            yield tile(held)

    return run
