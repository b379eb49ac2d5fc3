"""A manifest of a dataset as hash trees, and proofs for many of its leaves at once.

One tree per language, whose roots are the leaves of a last tree. Every eight
neighbours of a level become one node of the next. Leaves are cut into tiles of 8^4; a
tile is the bounded piece one task hashes four levels of, and the piece leaves are
proved in: the nodes its leaves lack together (each once, and none that follows from the
leaves themselves) are worked out, fetched by one join, the inner nodes shared by the
leaves are derived, and the proof of every leaf is written out from them ("octopus").
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import lower_az, scratch, stored
from tallyhouse.operators.ranking import global_rank
from tallyhouse.sources.tables import TableFolder

FAN = 8
TILE_LEVELS = 4
TILE = FAN**TILE_LEVELS
TOP = -1  # the tree over the roots of the others
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def width(n: int, level: int) -> int:
    """Nodes of a level of a tree with ``n`` leaves."""
    return -(-n // FAN**level)


def height(n: int) -> int:
    """The level at which one node is left; a lone leaf is its own root."""
    level = 0
    while width(n, level) > 1:
        level += 1
    return level


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """The leaf of a row, with some of its columns replaced."""
    return F.sha2(F.concat(*[_field(changed.get(c, F.col(c))) for c in FIELDS]), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: doc_id, leaf, tree, n, pos, tree_pos, trees, and what was carried along.

    ``nodes``: tree, level (from 1), pos, hash. A tree is named by the place of its first
    leaf among all; ``TOP`` is the tree over the others. ``root`` is None without rows.
    """

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def _levels(rows: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """All nodes above the leaves (tree, n, pos, hash), stored, four levels a round.

    A group is a tile of one tree, 4,096 rows at most, whatever the size of the tree.
    """

    def tile_levels(base: int):
        def hashed(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("pos")
            tree, n, tile = int(frame["tree"].iloc[0]), int(frame["n"].iloc[0]), int(frame["tile"].iloc[0])
            nodes, first, out = frame["hash"].tolist(), tile * TILE, []
            for step in range(1, TILE_LEVELS + 1):
                if width(n, base + step - 1) == 1:
                    break
                nodes = [digest(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
                first //= FAN
                out += [(tree, n, base + step, first + i, node) for i, node in enumerate(nodes)]
            return pd.DataFrame(out, columns=["tree", "n", "level", "pos", "hash"])

        return hashed

    made, base = [], 0
    while width(largest, base) > 1:
        tiled = rows.withColumn("tile", F.floor(F.col("pos") / TILE).cast("long"))
        nodes = tiled.groupBy("tree", "tile").applyInPandas(
            tile_levels(base), "tree long, n long, level int, pos long, hash string"
        )
        made.append(stored(nodes, f"{name}-levels"))
        base += TILE_LEVELS
        going_on = made[-1].filter((F.col("level") == base) & (F.col("n") > FAN**base))
        rows = going_on.select("tree", "n", "pos", "hash")
    return made


def manifest(docs: DataFrame, **carried: Column) -> Manifest:
    """Hash every row of ``docs`` into the tree of its language.

    Leaves ascend by doc_id, null first; rows of one doc_id ascend by their hash, so
    that equal tables have equal roots. A null language is a tree of its own, the first.
    Nulls in any column have a form of their own in the leaf, so null and empty differ.
    Texts are hashed whole where they are read, and only hashes travel. ``carried``
    columns of ``docs`` are kept with the leaves; others are not read.
    """
    spark = docs.sparkSession
    kept = [c.alias(name) for name, c in carried.items()]
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf_hash().alias("leaf"), *kept)
    hashed = stored(hashed, "leaves").withColumn("_row", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("lang"), F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("_row")]
    folder = TableFolder(spark, scratch(spark, "places"))
    placed = global_rank(hashed, order, folder, "leaves").drop("_row", "rows_total")
    langs = stored(placed.groupBy("lang").agg(F.min("rank").alias("tree"), F.count(F.lit(1)).alias("n")), "languages")
    # One row per language, brought into order like any other table.
    ranked = global_rank(langs.select("tree", "n", "lang"), [F.asc("tree")], folder, "languages")
    trees = stored(
        ranked.select("tree", "n", "lang", (F.col("rank") - 1).alias("tree_pos"), F.col("rows_total").alias("trees")), "trees"
    )
    leaves = placed.join(trees, placed["lang"].eqNullSafe(trees["lang"])).select(
        "doc_id", "leaf", "tree", "n", (F.col("rank") - F.col("tree")).alias("pos"), "tree_pos", "trees", *carried
    )
    sizes = trees.agg(F.max("n").alias("n"), F.max("trees").alias("trees")).first()
    if sizes["n"] is None:
        return Manifest(leaves, spark.createDataFrame([], "tree long, level int, pos long, hash string"), None)
    inner = _levels(leaves.select("tree", "n", "pos", F.col("leaf").alias("hash")), sizes["n"], "tree")
    lone = leaves.filter("n = 1").select("tree", F.col("leaf").alias("hash"))
    roots = lone
    for nodes in inner:
        last = (F.col("pos") == 0) & (F.col("n") > F.pow(F.lit(float(FAN)), F.col("level") - 1)) & (F.col("n") <= F.pow(F.lit(float(FAN)), F.col("level")))
        roots = roots.unionByName(nodes.filter(last).select("tree", "hash"))
    subroots = stored(
        trees.join(roots, "tree").select(F.lit(TOP).cast("long").alias("tree"), F.col("trees").alias("n"), F.col("tree_pos").alias("pos"), "hash"),
        "subroots",
    )
    top = _levels(subroots, sizes["trees"], "top")
    everything = subroots.select("tree", F.lit(0).alias("level"), "pos", "hash")
    for nodes in [*inner, *top]:
        everything = everything.unionByName(nodes.select("tree", "level", "pos", "hash"))
    root = (top[-1].orderBy(F.desc("level")) if top else subroots).first()["hash"]
    return Manifest(leaves, everything, root)


def missing(wanted: set[int], n: int) -> list[tuple[int, int]]:
    """(level, pos) of the fewest nodes that lead from these leaves to the root."""
    out, known = [], wanted
    for level in range(height(n)):
        parents = {p // FAN for p in known}
        for parent in sorted(parents):
            run = range(parent * FAN, min((parent + 1) * FAN, width(n, level)))
            out += [(level, p) for p in run if p not in known]
        known = parents
    return out


def _derived(known: dict[int, str], n: int, fetched: dict[tuple[int, int], str]) -> list[dict[int, list[str]]]:
    """Per level the runs that hold a known node, by the place of their parent."""
    levels = []
    for level in range(height(n)):
        runs = {}
        for parent in {p // FAN for p in known}:
            places = range(parent * FAN, min((parent + 1) * FAN, width(n, level)))
            runs[parent] = [known[p] if p in known else fetched[level, p] for p in places]
        levels.append(runs)
        known = {parent: digest(run) for parent, run in runs.items()}
    return levels


class _Paths:
    """The runs above a place, level by level, each walked once per node."""

    def __init__(self, levels: list[dict[int, list[str]]]):
        self.levels = levels
        self._above: dict[tuple[int, int], str] = {}

    def siblings(self, pos: int, level: int = 0) -> str:
        """The hashes beside a node and beside the nodes above it, left to right, from below."""
        if level == len(self.levels):
            return ""
        if (level, pos) not in self._above:
            run, own = self.levels[level][pos // FAN], pos % FAN
            beside = "".join(run[:own] + run[own + 1 :]) + self.siblings(pos // FAN, level + 1)
            if level == 0:
                return beside
            self._above[level, pos] = beside
        return self._above[level, pos]

    def fold(self, node: str, pos: int) -> str:
        """The root that follows from a node at this place and its siblings."""
        for runs in self.levels:
            run = list(runs[pos // FAN])
            run[pos % FAN] = node
            node, pos = digest(run), pos // FAN
        return node


def prove(made: Manifest, wanted: DataFrame | None = None, claimed: str = "leaf") -> DataFrame:
    """Per wanted leaf: doc_id, leaf, subroot, proof and folded_root.

    ``wanted`` are rows of ``made.leaves`` (by default all). ``proof`` is the hashes
    beside the leaf and beside the nodes above it, through the root of its tree to the
    root of all, 64 characters each. ``folded_root`` is what follows from the hash in
    column ``claimed`` and these; it is the root exactly if the claimed hash is right.

    Nodes are fetched once per tile, however many of its leaves are wanted. A tile is
    4,096 leaves at most, and lacks at most seven nodes per level above it.
    """
    wanted = made.leaves if wanted is None else wanted
    wanted = wanted.withColumn("tile", F.floor(F.col("pos") / TILE).cast("long"))

    def coordinates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples():
                lacking = [(row.tree, level, pos) for level, pos in missing(set(row.places), row.n)]
                lacking += [(TOP, level, pos) for level, pos in missing({row.tree_pos}, row.trees)]
                out += [(row.tree, row.tile, *node) for node in lacking]
            yield pd.DataFrame(out, columns=["tree", "tile", "of_tree", "level", "at"])

    asked = wanted.groupBy("tree", "tile").agg(
        F.first("n").alias("n"), F.first("tree_pos").alias("tree_pos"), F.first("trees").alias("trees"), F.collect_set("pos").alias("places")
    )
    lacking = stored(asked.mapInPandas(coordinates, "tree long, tile long, of_tree long, level int, at long"), "lacking")
    lowest = lacking.filter(F.col("of_tree") != TOP).agg(F.min("level")).first()[0]
    known = made.nodes.filter(F.col("tree") == TOP)
    if lowest is not None:
        known = made.nodes.filter((F.col("tree") == TOP) | (F.col("level") >= lowest))
    if lowest == 0:
        known = known.unionByName(made.leaves.select("tree", F.lit(0).alias("level"), "pos", F.col("leaf").alias("hash")))
    known = known.select(F.col("tree").alias("of_tree"), "level", F.col("pos").alias("at"), "hash")
    fetched = lacking.join(known, ["of_tree", "level", "at"])

    def expand(leaves: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "leaf", "subroot", "proof", "folded_root"]
        if leaves.empty:
            return pd.DataFrame(columns=columns)
        n, tree_pos, trees = (int(leaves[c].iloc[0]) for c in ("n", "tree_pos", "trees"))
        inside, above = {}, {}
        for of_tree, level, at, node in zip(nodes["of_tree"], nodes["level"], nodes["at"], nodes["hash"]):
            (above if of_tree == TOP else inside)[int(level), int(at)] = node
        places = [int(p) for p in leaves["pos"]]
        own = _Paths(_derived(dict(zip(places, leaves["leaf"])), n, inside))
        subroot = own.fold(leaves["leaf"].iloc[0], places[0])
        last = _Paths(_derived({tree_pos: subroot}, trees, above))
        beyond = last.siblings(tree_pos)
        folded = [last.fold(own.fold(given, p), tree_pos) for given, p in zip(leaves[claimed], places)]
        return pd.DataFrame(
            {
                "doc_id": leaves["doc_id"],
                "leaf": leaves["leaf"],
                "subroot": subroot,
                "proof": [own.siblings(p) + beyond for p in places],
                "folded_root": folded,
            }
        )[columns]

    needed = ["tree", "tile", "leaf", "n", "pos", "tree_pos", "trees", *([claimed] if claimed != "leaf" else [])]
    proved = (
        # As text: pandas would round large ids beside a null one.
        wanted.select(*needed, F.col("doc_id").cast("string").alias("doc_id"))
        .groupBy("tree", "tile")
        .cogroup(fetched.groupBy("tree", "tile"))
        .applyInPandas(expand, "doc_id string, leaf string, subroot string, proof string, folded_root string")
    )
    return proved.withColumn("doc_id", F.col("doc_id").cast("long"))


def audit(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    What is checked is the row as it is, but where three divides the crc32 of its doc_id
    the text in lower case (A-Z), which changes the leaf unless there is nothing to
    change. A row with a null doc_id is checked as it is. Equal rows are leaves of their
    own. An empty table gives no rows.
    """
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    claimed = F.when(touched, leaf_hash(text=lower_az(F.col("text")))).otherwise(leaf_hash())
    made = manifest(docs, claimed=claimed)
    return prove(made, claimed="claimed").select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(made.root).cast("string").alias("root"),
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.lit(made.root)).alias("verified"),
    )
