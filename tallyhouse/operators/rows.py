"""Row-level operators: deduplication, Unknown members, key resolution."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.sources.tables import TableFolder

# Above one copy in so many rows, all rows are ordered by key at once.
FEW = 10


def dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the first one when ordered by all other columns.

    The order is total, so the survivor does not depend on how rows arrive.
    Spark turns the ``= 1`` filter into a group limit before the shuffle as
    well, so a key with very many copies leaves each task as one row.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    order = rest or [F.col(keys[0])]
    window = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn("_copy", F.row_number().over(window))
    return numbered.filter(F.col("_copy") == 1).drop("_copy")


def hash_of(keys: Sequence[str]):
    return F.xxhash64(*keys).alias("_key")


def hashes_again(df: DataFrame, keys: Sequence[str], folder: TableFolder) -> tuple[DataFrame, int, int]:
    """The 64-bit hashes of keys that several rows have, how many rows those are, and all rows.

    A hash and its count are all that is shuffled. The hashes (``_key``) are written, so
    Spark knows their size. Equal keys always share a hash; a few other keys may share one.
    """
    seen, often = Observation(), F.col("_n") > 1
    counted = df.groupBy(hash_of(keys)).agg(F.count(F.lit(1)).alias("_n")).observe(
        seen, F.sum("_n").alias("rows"), F.sum(F.when(often, F.col("_n"))).alias("again")
    )
    again = folder.write(f"again-{uuid.uuid4().hex}", counted.filter(often).select("_key"))
    return again, seen.get["again"] or 0, seen.get["rows"] or 0


def dedup_few(df: DataFrame, keys: Sequence[str], folder: TableFolder) -> DataFrame:
    """The rows of ``dedup``, without a shuffle of those whose key stands alone.

    Only rows whose hash occurs again are ordered and thinned, by the keys themselves.
    Where such rows are many, all rows go through ``dedup``.
    """
    again, copies, rows = hashes_again(df, keys, folder)
    if not copies:
        return df
    if copies * FEW > rows:
        return dedup(df, keys)
    marked = df.withColumn("_key", hash_of(keys))
    alone = marked.join(again, "_key", "left_anti")
    others = marked.join(again, "_key", "left_semi").drop("_key")
    return alone.drop("_key").unionByName(dedup(others, keys))


def with_unknown(df: DataFrame, member: Mapping) -> DataFrame:
    """Append the Unknown member; columns not named in ``member`` are NULL."""
    unused = set(member) - set(df.columns)
    if unused:
        raise ValueError(f"no such columns: {sorted(unused)}")
    row = df.sparkSession.range(0, 1, 1, 1).select(
        *[F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema]
    )
    return df.unionByName(row)


def resolve_fk(
    df: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, object],
) -> DataFrame:
    """Left join a dimension on its business key and take some of its columns.

    ``on`` maps a column of ``df`` to the business key. ``take`` maps a column
    of the dimension to the value used when there is no match (None keeps
    NULL). Every row of ``df`` is kept. There is no broadcast hint: dimensions
    are read from written tables, so Spark knows their size and decides.
    """
    (left_key, business_key), = on.items()
    looked_up = dimension.select(
        F.col(business_key).alias("_business_key"),
        *[F.col(c).alias(f"_take_{c}") for c in take],
    )
    joined = df.join(looked_up, F.col(left_key) == F.col("_business_key"), "left")
    values = []
    for name, default in take.items():
        found = F.col(f"_take_{name}")
        values.append((found if default is None else F.coalesce(found, F.lit(default))).alias(name))
    return joined.select(*[F.col(c) for c in df.columns if c not in take], *values)


def unknown_if_missing(name: str):
    return F.coalesce(F.col(name), F.lit(fixed.UNKNOWN_KEY))
