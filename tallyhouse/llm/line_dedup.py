"""Line deduplication over overlapping windows of consecutive lines.

Each run of three lines is hashed; a run that occurs more than once in the whole
corpus keeps its first occurrence, in the order of doc_id and place. The lines of all
later occurrences are removed; occurrences that overlap are merged by their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import release, same_key, stored, text_key, with_spans

KEY = ["doc_id", "_text"]
# Bits of a map per document in it, and the most bits sent to every task (8 MB).
SPARSE = 16
MOST_BITS = 1 << 26


def _touched(docs: DataFrame, covered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` (with ``_text``) that surely have nothing in ``covered``, and the rest.

    One bit per hashed ``_text``, sixteen times as many as are set: only about one in
    sixteen of the documents without repeated lines is taken for one with them, and only
    the rest is shuffled. A map too large to be sent is not used; then all are the rest.
    """
    n = covered.count()
    bits = 1 << max(15, (SPARSE * n).bit_length())
    if bits > MOST_BITS:
        return docs.limit(0), docs
    place = F.pmod(F.xxhash64(F.lit(5), "_text"), F.lit(bits))
    marks = stored(
        covered.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits")),
        "marks",
    )
    at = F.bitmap_bit_position(place)
    byte = F.substring("_bits", (at / 8).cast("int") + 1, 1)
    found = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0
    tested = docs.join(F.broadcast(marks), F.bitmap_bucket_number(place) == F.col("_bucket"), "left")
    tested = tested.withColumn("_found", F.coalesce(found, F.lit(False)))
    return tested.filter("not _found").select(*docs.columns), tested.filter("_found").select(*docs.columns)


def _with_left(docs: DataFrame, lines: int) -> DataFrame:
    """Per row of ``docs``: the row, ``_text``, ``_n_lines``, ``_n_removed`` and ``_left`` (null if all is)."""
    docs = docs.select(F.struct("*").alias("_row"), "doc_id", "text", text_key(F.col("text")).alias("_text"))
    # Rows written several times give equal runs, which count as one occurrence below.
    split = docs.filter(F.col("text").isNotNull()).select(*KEY, F.split("text", "\n", -1).alias("_lines"))
    hashed = split.withColumn("_h", F.transform("_lines", lambda x: F.xxhash64(x)))
    hashed = hashed.withColumn("_g", F.transform("_lines", lambda x: F.xxhash64(F.lit(7), x)))
    hashed = hashed.withColumn("_w", F.transform("_lines", lambda x: F.trim(x) != ""))
    hashed = with_spans(hashed, "_h", "_a", lines, lambda x, y: F.xxhash64(x, y))
    hashed = with_spans(hashed, "_g", "_b", lines, lambda x, y: F.xxhash64(x, y))
    hashed = with_spans(hashed, "_w", "_full", lines, lambda x, y: F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False)))
    runs = hashed.select(
        *KEY,
        F.posexplode(
            F.arrays_zip(F.col("_a").alias("a"), F.col("_b").alias("b"), F.col("_full").alias("full"))
        ).alias("pos", "run"),
    ).filter("run.full").select(*KEY, "pos", "run.a", "run.b")
    runs = stored(runs, "runs")
    here = F.struct("doc_id", "_text", "pos")
    first = stored(
        runs.groupBy("a", "b")
        .agg(F.min(here).alias("first"), F.max(here).alias("last"))
        .filter("first != last")
        .drop("last"),
        "first",
    )
    later = runs.join(first, ["a", "b"]).filter(~here.eqNullSafe(F.col("first")))
    covered = stored(later.groupBy(*KEY).agg(F.collect_set("pos").alias("runs")), "covered")
    release(runs, first)

    whole, rest = _touched(docs, covered)
    # The same join at every size: what is left of the texts is seldom small.
    joined = rest.join(covered.hint("merge"), same_key(rest, covered, KEY), "left").select(rest["*"], "runs")
    joined = whole.withColumn("runs", F.lit(None).cast("array<int>")).unionByName(joined)
    joined = joined.withColumn("_lines", F.split("text", "\n", -1))
    n_lines = F.coalesce(F.size("_lines"), F.lit(0))
    removed = F.flatten(F.transform("runs", lambda p: F.sequence(p, p + (lines - 1))))
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    joined = joined.withColumn("_kept", F.when(F.col("runs").isNotNull(), F.array_except(places, removed)))
    left = F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")
    untouched = F.col("runs").isNull()
    return joined.select(
        "_row",
        "_text",
        n_lines.cast("long").alias("_n_lines"),
        F.when(untouched, F.lit(0)).otherwise(n_lines - F.size("_kept")).cast("long").alias("_n_removed"),
        F.when(~untouched, left).alias("_left"),
    )


def dedup_lines(docs: DataFrame, lines: int = 3) -> DataFrame:
    """Per document: doc_id, ``_text``, n_lines, n_removed and the text that is left.

    Lines end at a line feed and count only if equal in every character. A run of
    blank lines is no window, and a text of fewer than ``lines`` lines has none. Null
    texts stay null with 0 lines. A null doc_id comes first in the order. Rows equal
    in doc_id and text are one document written several times: all get what it gets.
    Texts are split whole, however long; an empty table gives no rows. The first
    occurrence is found by a minimum that is taken inside tasks before it is shuffled,
    and the join back to it is a plain equi join, which Spark splits where one window
    is hot. Of the texts only those with lines to remove are shuffled.
    """
    return _with_left(docs.select("doc_id", "text"), lines).select(
        F.col("_row.doc_id").alias("doc_id"),
        "_text",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.when(F.col("_n_removed") > 0, F.col("_left")).otherwise(F.col("_row.text")).alias("text"),
    )


def without_repeated_lines(docs: DataFrame, lines: int = 3) -> DataFrame:
    """The documents with the text that is left, and n_chars (if there) to match.

    A document of which nothing is left is a copy of what others keep, and goes.
    """
    left = _with_left(docs, lines).filter("_n_removed = 0 or _left != ''")
    cut = F.col("_n_removed") > 0
    changed = {"text": F.when(cut, F.col("_left")).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(cut, F.length("_left").cast(kind)).otherwise(F.col("_row.n_chars"))
    return left.select(*[(changed[c] if c in changed else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


SQL = r"""
with lines as (
  select doc_id, text, case when text is null then [] else string_split(text, chr(10)) end l from {documents}),
runs as (
  select doc_id, p, l[p] x, l[p + 1] y, l[p + 2] z
  from (select doc_id, l, unnest(range(1, len(l) - 1)) p from lines where len(l) >= 3)),
later as (
  select doc_id, p from (
    select doc_id, p, row_number() over (partition by x, y, z order by doc_id nulls first, p) k
    from runs where trim(x, ' ') != '' or trim(y, ' ') != '' or trim(z, ' ') != '') where k > 1),
covered as (select distinct doc_id, unnest([p, p + 1, p + 2]) q from later),
parts as (
  select doc_id, q, l[q] line, c.q is not null gone
  from (select doc_id, l, unnest(range(1, len(l) + 1)) q from lines) left join covered c using (doc_id, q))
select doc_id, cast(len(any_value(l)) as bigint) n_lines,
  cast(count(*) filter (gone) as bigint) n_removed,
  case when any_value(text) is null then null
       else coalesce(string_agg(line, chr(10) order by q) filter (not gone), '') end as text
from lines left join parts using (doc_id) group by doc_id
"""
