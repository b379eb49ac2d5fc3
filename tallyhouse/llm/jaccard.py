"""Documents whose sets of word shingles overlap: an exact Jaccard join.

1. Each text becomes a sorted array of 64-bit shingle hashes. Equal sets are one class.
2. Tiles band the sizes: a set is put into the tile of its size and, if small sets of
   the tile below could still link with it, into that one too. In each tile it stands
   under its first shingles in one global order. Two sets that link share one of them.
   The order puts frequent shingles last, so they are seldom among the first; it may
   be any order, so what it is made from can be bounded without losing a link.
3. Members of one tile and shingle are paired with the first and the last of them, a
   bound on the overlap from hashed bitmaps (bits that differ are elements that differ)
   and the sizes throws out most pairs, and the rest is decided by an exact intersection.
4. Only where a tile and shingle still holds different components are its remaining
   pairs between components looked at, in the same way, and of several shingles with
   the same members only one is. Pairs inside a component cannot change it, so a large
   group of copies is never expanded into all its pairs.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import release, small, stored
from tallyhouse.llm.components import components

# Frequent shingles that the order knows, at most; 8 bytes each in every task.
HOT_SHINGLES = 250_000
# Longs of a piece of a bitmap; the whole one grows with the set, by powers of two.
BRIEF = 32
TILE_BITS = 10
CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * CHUNK)
        _powers[:] = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers[0], _powers[1]


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of UTF-8 texts laid end to end, and the words before each text.

    Words are runs without the six ASCII blanks; A-Z count as a-z. ``starts`` has the
    first byte of each text and the end of the last.
    """
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[starts] = True
    word = ~blank
    before = np.concatenate(([False], word[:-1]))
    first = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate((word[1:], [False]))
    last = np.flatnonzero(word & (~after | edge[1:])) + 1
    power, inverse = _power_tables(len(data) + 1)
    lowered = data + 32 * ((data >= 65) & (data <= 90)).astype(np.uint8)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((lowered.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    hashes = _stir((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(first, starts)


def _of_batch(batch: pa.RecordBatch, k: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Row numbers and their sorted distinct shingle hashes, a bounded chunk at a time."""
    text = batch.column("text").cast(pa.large_binary())
    if text.null_count:
        text = text.fill_null(b"")
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    everything = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        to = min(to, len(text))
        data = everything[offsets[at] : offsets[to]]
        hashes, word_at = _word_hashes(data, offsets[at : to + 1] - offsets[at])
        rolled = hashes.copy()
        for j in range(1, k):
            rolled[: len(hashes) - j] = _stir(rolled[: len(hashes) - j] * _BASE + hashes[j:])
        sets = []
        for d in range(to - at):
            lo, hi = word_at[d], word_at[d + 1]
            if hi - lo >= k:
                sets.append(np.unique(rolled[lo : hi - k + 1]))
            elif hi > lo:
                one = np.uint64(hi - lo)
                for h in hashes[lo:hi]:
                    one = _stir(np.array([one]) * _BASE + h)[0]
                sets.append(np.array([one]))
            else:
                sets.append(np.zeros(0, dtype=np.uint64))
        yield list(range(at, to)), sets
        at = to


def _hot(docs: DataFrame, k: int, least: int = 4) -> np.ndarray:
    """Frequent shingles, least frequent first. Counted over all texts, inside tasks."""

    def count(batches):
        total_keys, total = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for _, sets in _of_batch(batch, k):
                keys, n = np.unique(np.concatenate(sets), return_counts=True)
                keys, n = keys[n >= 2], n[n >= 2]
                both = np.concatenate((total_keys, keys))
                total_keys, place = np.unique(both, return_inverse=True)
                total = np.bincount(place, np.concatenate((total, n)), len(total_keys)).astype(np.int64)
                if len(total_keys) > 4 * HOT_SHINGLES:
                    best = np.sort(np.argpartition(total, -2 * HOT_SHINGLES)[-2 * HOT_SHINGLES :])
                    total_keys, total = total_keys[best], total[best]
        keep = total >= least
        keys, n = total_keys[keep].view(np.int64), total[keep]
        for at in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at : at + 100_000]), pa.array(n[at : at + 100_000])], names=["token", "n"]
            )

    counted = docs.select("text").mapInArrow(count, "token long, n long")
    top = (
        counted.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(HOT_SHINGLES).toArrow()
    )
    tokens = top.column("token").to_numpy().view(np.uint64) if len(top) else np.zeros(0, np.uint64)
    return tokens[::-1].copy()


def _longs(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _bitmap(tokens: np.ndarray, width: int) -> np.ndarray:
    """Hashed bits of a set. Both halves put together are the bitmap of half the width."""
    bits = np.zeros(width, dtype=np.uint8)
    bits[(tokens >> np.uint64(7)) % np.uint64(width)] = 1
    return np.packbits(bits).view(np.uint64)


def _longs_of(n: int) -> int:
    """Longs of the bitmap of a set of ``n``: two to four bits for each element."""
    return max(BRIEF, (2 << n.bit_length()) // 64)


def _piece(percent: int) -> Column:
    """The piece of ``bitmap`` that ``key`` looks at, the same for all sets under a key.

    A long set is too dense for a short bitmap. A piece of its long one holds only the
    elements of one part of the hash range, and what differs there is at most what
    differs at all. The bitmap is folded to the width of the tile's least set first.
    """
    widths = F.array(*[F.lit(_longs_of(n)) for n in _tile_bounds(percent)])
    width = F.get(widths, F.col("key").bitwiseAND(F.lit((1 << TILE_BITS) - 1)).cast("int"))
    part = F.pmod(F.shiftright("key", TILE_BITS), (width / BRIEF).cast("long")).cast("int")
    start = part * BRIEF + 1
    folded = F.zip_with(
        F.slice("bitmap", start, F.lit(BRIEF)), F.slice("bitmap", start + width, F.lit(BRIEF)), lambda x, y: x.bitwiseOR(y)
    )
    return F.when(F.size("bitmap") > width, folded).otherwise(F.slice("bitmap", start, F.lit(BRIEF)))


def _signed(docs: DataFrame, k: int, percent: int, hot: np.ndarray) -> DataFrame:
    """Per row: doc_id, n, the set as 128 bits (k1, k2), its bitmap, and its join keys."""
    shared = docs.sparkSession.sparkContext.broadcast((np.sort(hot), np.argsort(hot)))

    def sign(batches):
        hot_tokens, hot_rank = shared.value
        for batch in batches:
            for rows, sets in _of_batch(batch, k):
                n, k1, k2, maps, keys = [], [], [], [], []
                for tokens in sets:
                    n.append(len(tokens))
                    k1.append(np.bitwise_xor.reduce(_stir(tokens + np.uint64(11))) if len(tokens) else 0)
                    k2.append(_stir(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) if len(tokens) else 0)
                    maps.append(_bitmap(tokens, 64 * _longs_of(len(tokens))))
                    keys.append(_keys(tokens, percent, hot_tokens, hot_rank))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows)),
                        pa.array(n, pa.int64()),
                        pa.array(np.array(k1, np.uint64).view(np.int64)),
                        pa.array(np.array(k2, np.uint64).view(np.int64)),
                        _longs(maps),
                        _longs(keys),
                    ],
                    names=["doc_id", "n", "k1", "k2", "bitmap", "keys"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        sign,
        "doc_id long, n long, k1 long, k2 long, bitmap array<long>, keys array<long>",
    )


@cache
def _tile_bounds(percent: int) -> list[int]:
    """The least size of each tile. A tile is two size ratios wide, so about half of the
    sets can link with the tile below, and none beyond it."""
    bounds = [1]
    while bounds[-1] < 1 << 31:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 10_000 // percent**2)))
    return bounds


def _keys(tokens: np.ndarray, percent: int, hot_tokens: np.ndarray, hot_rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the global order, under each of its tiles."""
    n = len(tokens)
    if not n:
        return tokens
    length = n - -(-percent * n // 100) + 1
    frequent = np.zeros(n, dtype=bool)
    if len(hot_tokens):
        at = np.minimum(np.searchsorted(hot_tokens, tokens), len(hot_tokens) - 1)
        frequent = hot_tokens[at] == tokens
    first = tokens[~frequent][:length]
    if len(first) < length:
        last = tokens[frequent][np.argsort(hot_rank[at[frequent]], kind="stable")]
        first = np.concatenate((first, last[: length - len(first)]))
    least = _tile_bounds(percent)
    tile = bisect_right(least, n) - 1
    # Sets of the tile below are smaller than the smallest of this one.
    tiles = [tile, tile - 1] if tile and percent * n <= 100 * (least[tile] - 1) else [tile]
    # The lowest bits of a key name its tile.
    keys = [_stir(first ^ np.uint64(0x51ED270B9F * (t + 1))) for t in tiles]
    return np.concatenate([(x << np.uint64(TILE_BITS)) | np.uint64(t) for x, t in zip(keys, tiles)])


def _sizes_link(x: str, y: str, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _may_differ(x: str, y: str, percent: int) -> Column:
    """Elements by which two sets of these sizes that link can differ at most."""
    both = F.col(x) + F.col(y)
    return both - 2 * F.ceil(both * percent / (100 + percent) - F.lit(1e-9))


def _halved(bitmap: str, width: Column) -> Column:
    folded = F.zip_with(
        F.slice(bitmap, F.lit(1), width), F.slice(bitmap, width + 1, width), lambda x, y: x.bitwiseOR(y)
    )
    return F.when(F.size(bitmap) > width, folded).otherwise(F.col(bitmap))


def _verified(docs: DataFrame, pairs: DataFrame, own: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link: bounded by size and bitmap, then intersected.

    Only sets that stand in a pair are made again from their texts, and each is sent
    to its partners directly.
    """
    left = own.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ba"))
    right = own.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("bb"))
    # Sizes that can link differ by less than two, so at most one fold makes them even.
    width = F.least(F.size("ba"), F.size("bb"))
    differ = F.aggregate(
        F.zip_with(_halved("ba", width), _halved("bb", width), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda s, x: s + x,
    )
    kept = pairs.join(left, "a").join(right, "b").filter(
        _sizes_link("na", "nb", percent) & (differ <= _may_differ("na", "nb", percent))
    )
    kept = stored(kept.select("a", "b"), "bounded")
    firsts = stored(kept.select(F.col("a").alias("doc_id")).distinct(), "firsts")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def sets_of(batches):
        for batch in batches:
            for rows, sets in _of_batch(batch, k):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(pa.array(rows)), batch.column("b").take(pa.array(rows)),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["a", "b", "set"],
                )

    schema = "a long, b array<long>, set binary"
    seconds = kept.groupBy("b").agg(F.collect_list("a").alias("partners"))
    seconds = stored(seconds.withColumnRenamed("b", "doc_id"), "seconds")
    of_first = texts.join(small(firsts), "doc_id").select(F.col("doc_id").alias("a"), F.lit(None).cast("array<long>").alias("b"), "text")
    of_first = of_first.mapInArrow(sets_of, schema).select("a", F.col("set").alias("sa"))
    of_second = texts.join(small(seconds), "doc_id").select(F.col("doc_id").alias("a"), F.col("partners").alias("b"), "text")
    of_second = of_second.mapInArrow(sets_of, schema).select(
        F.explode("b").alias("a"), F.col("a").alias("b"), F.col("set").alias("sb")
    )

    def intersect(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(100 * common >= percent * (len(x) + len(y) - common)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_sets = of_second.join(of_first, "a")
    links = stored(with_sets.select("a", "b", "sa", "sb").mapInArrow(intersect, "a long, b long"), "links")
    release(kept, firsts, seconds)
    return links


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id linked to it).

    Sets link if 100 * intersection >= percent * union. A null or blank text has an
    empty set that links with nothing. Rows that share a doc_id are one node with
    several texts. A row without doc_id links only with sets equal to its own, and
    its component is null if none of them has an id.
    """
    docs = docs.select("doc_id", "text")
    signed = stored(_signed(docs, k, percent, _hot(docs, k)), "signed")
    classes = stored(
        signed.filter("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes"
    )
    reps = classes.filter("rep is not null").select(F.col("rep").alias("doc_id"), "k1", "k2")
    signed_reps = signed.join(small(reps), ["doc_id", "k1", "k2"], "left_semi")
    own = stored(signed_reps.select("doc_id", "n", "bitmap"), "own")
    members = signed_reps.select("doc_id", "n", F.explode("keys").alias("key"))
    lo = F.min(F.struct("doc_id", "n")).alias("lo")
    groups = stored(members.groupBy("key").agg(F.count(F.lit(1)).alias("c"), lo).filter("c > 1"), "groups")
    # The same join at every size: few keys are shared only where there are few texts.
    members = stored(members.join(groups.hint("merge"), "key"), "members")
    # Sizes go with the members, so that no bitmap is sent for a pair they rule out.
    pairs = members.filter((F.col("doc_id") != F.col("lo.doc_id")) & _sizes_link("n", "lo.n", percent))
    pairs = stored(pairs.select(F.col("lo.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    links = _verified(docs, pairs, own, k, percent)
    known = components(links)

    open_members = members.filter("c > 2").select("key", "doc_id")
    of = F.coalesce("component", "doc_id").alias("component")
    open_members = stored(
        open_members.join(known, open_members["doc_id"] == known["node"], "left").select("key", "doc_id", of), "open"
    )
    # Long texts with a common passage share very many keys; keys with the same members
    # have the same pairs, so one of them is enough. Sums of halves do not overflow.
    h = F.xxhash64("doc_id")
    same_members = ["c", "xor", "low", "high"]
    by_key = open_members.groupBy("key").agg(
        F.min("component").alias("x"),
        F.max("component").alias("y"),
        F.count(F.lit(1)).alias("c"),
        F.bit_xor(F.xxhash64(F.lit(3), "doc_id")).alias("xor"),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned(h, 32)).alias("high"),
    )
    mixed = stored(
        by_key.filter("x != y").groupBy(*same_members).agg(F.min("key").alias("key")).select("key"), "mixed"
    )
    rest = open_members.join(mixed, "key", "left_semi").join(own, "doc_id")
    rest = stored(rest.select("key", "doc_id", "component", "n", _piece(percent).alias("brief")), "rest")
    # Both sides are the same columns of one frame, so it is shuffled once.
    x, y = rest.alias("x"), rest.alias("y")
    differ = reduce(
        add, [F.bit_count(F.get("x.brief", F.lit(i)).bitwiseXOR(F.get("y.brief", F.lit(i)))) for i in range(BRIEF)]
    )
    more = (
        x.join(
            y,
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.doc_id") < F.col("y.doc_id"))
            & (F.col("x.component") != F.col("y.component"))
            & _sizes_link("x.n", "y.n", percent)
            & (differ <= _may_differ("x.n", "y.n", percent)),
        )
        .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
        .distinct()
    )
    more = stored(more.join(pairs, ["a", "b"], "left_anti"), "more")
    if not more.isEmpty():
        added = _verified(docs, more, own, k, percent)
        known = components(links.unionByName(added))
        release(added)
    release(own, groups, members, pairs, links, open_members, mixed, rest, more)

    of_class = classes.join(known, classes["rep"] == known["node"], "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component_id")
    )
    full = signed.select("doc_id", "n", "k1", "k2")
    return full.join(of_class, ["k1", "k2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each group the one with the smallest id stays.

    Rows with equal doc_id are one document, of which one row stays; rows without
    doc_id stay.
    """
    found = jaccard_components(docs, k, percent)
    gone = stored(found.filter("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    left = docs.join(small(gone), docs["doc_id"] == gone["_gone"], "left_anti")
    repeated = (
        docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    repeated = stored(repeated.select(F.col("doc_id").alias("_twice")), "repeated")
    if repeated.isEmpty():
        return left
    once = left.join(small(repeated), left["doc_id"] == repeated["_twice"], "left_anti")
    twice = left.join(small(repeated), left["doc_id"] == repeated["_twice"], "left_semi")
    return once.unionByName(twice.dropDuplicates(["doc_id"]))
