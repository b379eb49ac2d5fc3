"""Benchmark decontamination by winnowing, with DataFrame functions only.

The words of a text are hashed, runs of ``k`` words are hashed from them, and in each
sliding window of ``span - k + 1`` runs the smallest hash is its fingerprint. A shared
span of ``span`` words is exactly one such window, so both sides select the same
fingerprint for it: no shared span is missed. Fingerprints of documents are joined
with those of the benchmark; a document with a common one is a candidate. In the
candidates each hit is extended to its whole window and compared by a 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import (
    BROADCAST_ROWS,
    lower_az,
    release,
    same_key,
    small,
    stored,
    text_key,
    with_spans,
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["doc_id", "_text"]


def _words(text: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), none)


def _coarse(text: Column) -> Column:
    """Full lower case of every character for itself: that of a capital sigma would depend
    on its neighbours, also on those that part words here."""
    return F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3")))


def _mix(x: Column, y: Column) -> Column:
    return F.xxhash64(x, y)


def _with_fingerprints(df: DataFrame, span: int, k: int) -> DataFrame:
    """From ``_words``: the word hashes and ``_fp``, a fingerprint per span."""
    df = df.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    df = with_spans(df, "_h", "_gram", k, _mix)
    return with_spans(df, "_gram", "_fp", span - k + 1, lambda x, y: F.least(x, y))


def _with_windows(df: DataFrame, lengths: list[int], span: int, k: int) -> DataFrame:
    """Add ``_at``: (pos, len, fp, a, b) for each run of each wanted length.

    Runs of ``span`` words carry their winnowing fingerprint; shorter ones, wanted
    only where the benchmark has an item of so few words, are their own fingerprint.
    """
    df = _with_fingerprints(df, span, k)
    df = df.withColumn("_g", F.transform("_words", lambda w: F.xxhash64(F.lit(7), w)))
    parts = []
    for n in lengths:
        df = with_spans(df, "_h", f"_a{n}", n, _mix)
        df = with_spans(df, "_g", f"_b{n}", n, _mix)
        fp = F.col("_fp") if n == span else F.col(f"_a{n}")
        runs = F.arrays_zip(fp.alias("fp"), F.col(f"_a{n}").alias("a"), F.col(f"_b{n}").alias("b"))
        parts.append(F.transform(runs, _placed(n)))
    return df.withColumn("_at", F.concat(*parts))


def _placed(n: int) -> Callable[[Column, Column], Column]:
    return lambda x, i: F.struct(
        i.alias("pos"), F.lit(n).alias("len"), x["fp"].alias("fp"), x["a"].alias("a"), x["b"].alias("b")
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = 10,
    k: int = 5,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated; and ``_text``.

    Null and empty texts have no words and are clean. Rows equal in doc_id and text
    are one document that is written several times; each gets the same result. An
    item without words matches nothing; an item without id marks words but is neither
    counted nor listed; items with equal ids are one. Items of fewer than ``span``
    words are one window of their own length. An empty benchmark leaves all clean.
    """
    docs = docs.select("doc_id", "text", text_key(F.col("text")).alias("_text"))
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item"), _words(lower_az(F.col("text"))).alias("_words")
    ).filter(F.size("_words") > 0)
    # At most span values, however large the benchmark.
    found = items.select(F.least(F.size("_words"), F.lit(span)).alias("n")).distinct().collect()
    lengths = sorted({r.n for r in found} | {span})
    windows = stored(
        _with_windows(items, lengths, span, k)
        .select("item", F.least(F.size("_words"), F.lit(span)).alias("own"), F.inline("_at"))
        .filter("len = own")
        .select("item", "len", "fp", "a", "b")
        .distinct(),
        "windows",
    )

    # The fingerprints of a document lead to its candidate flag; counted per task
    # before the shuffle, so one row per document moves. Full lower case is coarser
    # than A-Z, so nothing is lost here, and the word count is the same.
    first = docs.select("doc_id", "_text", _words(_coarse(F.col("text"))).alias("_words"))
    coarse = _with_fingerprints(first, span, k)
    short = [n for n in lengths if n < span]
    for n in short:
        coarse = with_spans(coarse, "_h", f"_s{n}", n, _mix)
    all_fp = F.concat("_fp", *[F.col(f"_s{n}") for n in short])
    lowered = stored(_coarse_windows(benchmark, span, k), "fingerprints")
    flagged = (
        coarse.select(
            "doc_id", "_text", F.size("_words").alias("n"), F.explode_outer(F.array_distinct(all_fp)).alias("fp")
        )
        .join(small(lowered.withColumn("hit", F.lit(1)), broadcast_rows), "fp", "left")
        .groupBy(*KEY)
        .agg(F.max("n").cast("long").alias("n_words"), F.max("hit").alias("candidate"))
    )
    flagged = stored(flagged, "flagged")

    chosen = flagged.filter("candidate = 1").select(*KEY)
    texts = docs.join(chosen, same_key(docs, chosen, KEY), "left_semi").dropDuplicates(KEY)
    texts = texts.select("doc_id", "_text", _words(lower_az(F.col("text"))).alias("_words"))
    at = _with_windows(texts, lengths, span, k).select(*KEY, F.inline("_at"))
    distinct = windows.select("len", "fp", "a", "b").distinct()
    each = stored(distinct, "distinct")
    hits = stored(
        at.join(small(each, broadcast_rows), ["len", "fp", "a", "b"])
        .select(*KEY, "pos", "len", "a", "b"),
        "hits",
    )
    release(each, lowered)
    covered = hits.groupBy(*KEY).agg(F.collect_set(F.struct("pos", "len")).alias("runs"))
    covered = covered.select(
        *KEY,
        F.size(
            F.array_distinct(
                F.flatten(F.transform("runs", lambda r: F.sequence(r["pos"], r["pos"] + r["len"] - 1)))
            )
        ).cast("long").alias("n_hit"),
    )
    of_window = small(windows.filter("item is not null").select("item", "len", "a", "b"), broadcast_rows)
    listed = (
        hits.select(*KEY, "len", "a", "b")
        .distinct()
        .join(of_window, ["len", "a", "b"])
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = covered.join(listed, same_key(covered, listed, KEY), "left").select(
        covered["doc_id"], covered["_text"], "n_hit", "items"
    )
    rows = docs.select(*KEY)
    out = rows.join(flagged, same_key(rows, flagged, KEY), "left").select(rows["*"], "n_words")
    none = F.array().cast("array<string>")
    items_of = F.coalesce(found["items"], none)
    return out.join(found, same_key(out, found, KEY), "left").select(
        out["doc_id"],
        out["_text"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def _coarse_windows(benchmark: DataFrame, span: int, k: int) -> DataFrame:
    """Fingerprints of the benchmark in full lower case."""
    items = benchmark.select(_words(_coarse(F.col("text"))).alias("_words")).filter(F.size("_words") > 0)
    long = _with_fingerprints(items, span, k).select(F.explode("_fp").alias("fp"))
    for n in range(1, span):
        few = items.filter(F.size("_words") == n).withColumn(
            "_h", F.transform("_words", lambda w: F.xxhash64(w))
        )
        long = long.unionByName(with_spans(few, "_h", "_a", n, _mix).select(F.explode("_a").alias("fp")))
    return long.distinct()


def clean_documents(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents that share no window with the benchmark, with all their columns."""
    bad = decontaminate(docs, benchmark, **parameters).filter("contaminated").select(*KEY).distinct()
    return docs.join(
        bad,
        docs["doc_id"].eqNullSafe(bad["doc_id"]) & text_key(docs["text"]).eqNullSafe(bad["_text"]),
        "left_anti",
    )


SQL = r"""
with items as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from {benchmark}),
windows as (
  select distinct item_id, least(len(w), 10) n, list_slice(w, i, i + least(len(w), 10) - 1) win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from items where len(w) > 0)),
docs as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w
  from {documents}),
places as (
  select doc_id, n, p, list_slice(w, p, p + n - 1) win
  from (select doc_id, n, w, unnest(range(1, len(w) - n + 2)) p
        from docs, (select distinct n from windows) where len(w) >= n)),
hits as (select doc_id, places.n, p, item_id from places join windows using (win)),
words as (
  select doc_id, count(distinct q) n_hit
  from (select doc_id, unnest(range(p, p + n)) q from hits) group by doc_id),
listed as (
  select doc_id, count(*) n_items, string_agg(i, ',' order by i) ids
  from (select distinct doc_id, cast(item_id as varchar) i from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from docs left join words using (doc_id) left join listed using (doc_id)
"""
