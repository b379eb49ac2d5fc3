"""Rankings: per group, top rows, and over a whole table without one big task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.sources.tables import TableFolder


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every group; ``order`` should end in a tie key."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def most_frequent(df: DataFrame, groups: Sequence[str], value: str, name: str) -> DataFrame:
    """The most frequent non-NULL value per group; ties go to the smallest.

    Values are counted first, so a group reaches the second step as one row per
    distinct value, however many rows it has.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).alias(name))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return top_per_group(counted, groups, [F.desc("_n"), F.asc(name)]).drop("_n")


def top_rows(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of the whole table (a top-k report)."""
    return df.orderBy(*order).limit(limit)


def share_of_group(df: DataFrame, value: str, groups: Sequence[str], name: str) -> DataFrame:
    """Add each row's part of its group's total."""
    whole = F.sum(F.col(value)).over(Window.partitionBy(*groups))
    return df.withColumn(
        name, F.try_divide(F.col(value).cast("double"), whole.cast("double"))
    )


@dataclass(frozen=True)
class Slices:
    """Rows cut into ordered slices, and what lies before each slice.

    ``rows`` has ``_slice`` and ``_place`` (0-based, inside the slice).
    ``before`` has one row per slice: ``_rows_before``, ``_rows_total`` and,
    when a value was named, ``_value_before`` and ``_value_total``.
    """

    rows: DataFrame
    before: DataFrame


# monotonically_increasing_id holds the partition above the row's place in it.
_PLACE_BITS = 33


def ordered_slices(
    df: DataFrame,
    order: Sequence[Column],
    folder: TableFolder,
    name: str,
    value: str | None = None,
) -> Slices:
    """Range-partition by ``order``, write the slices, and sum up what precedes.

    A window without PARTITION BY would sort the whole table in one task. Here
    every task sorts its own slice and notes each row's place, and only one row
    per slice (at most the number of shuffle partitions) goes through a single
    task. The slices are written before they are counted: a second range
    partitioning would sample anew and might cut elsewhere, and a written table
    survives a lost executor. ``order`` must be unique per row, so that no
    slice can be hot.
    """
    cut = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    # A folder of its own for each call: an earlier frame may not have been read yet.
    rows = folder.write(f"{name}-{uuid.uuid4().hex}", cut).select(
        *[F.col(c) for c in df.columns],
        F.shiftright("_id", _PLACE_BITS).alias("_slice"),
        F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("_place"),
    )
    sums = [F.count(F.lit(1)).alias("_n")]
    if value:
        sums.append(F.sum(value).alias("_v"))
    per_slice = rows.groupBy("_slice").agg(*sums)
    upto = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    columns = [
        F.col("_slice"),
        (F.sum("_n").over(upto) - F.col("_n")).alias("_rows_before"),
        F.sum("_n").over(every).alias("_rows_total"),
    ]
    if value:
        columns += [
            (F.sum("_v").over(upto) - F.coalesce("_v", F.lit(0))).alias("_value_before"),
            F.sum("_v").over(every).alias("_value_total"),
        ]
    return Slices(rows, per_slice.select(*columns))


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    folder: TableFolder,
    name: str,
    rank: str = "rank",
    value: str | None = None,
) -> DataFrame:
    """Number the rows 1..n over the whole table, in ``order``.

    Adds ``rank`` and ``rows_total``; with ``value`` also ``running_total`` and
    ``grand_total`` of that column. The rank needs no shuffle beyond the one
    that made the slices; a running total needs one more, by slice.
    """
    cut = ordered_slices(df, order, folder, name, value)
    # One row per slice: its size is bounded by the number of slices.
    rows = cut.rows.join(F.broadcast(cut.before), "_slice")
    columns = [
        *[F.col(c) for c in df.columns],
        (F.col("_rows_before") + F.col("_place") + 1).alias(rank),
        F.col("_rows_total").alias("rows_total"),
    ]
    if value:
        upto = (
            Window.partitionBy("_slice")
            .orderBy("_place")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        columns += [
            (F.coalesce(F.sum(value).over(upto), F.lit(0)) + F.col("_value_before")).alias(
                "running_total"
            ),
            F.col("_value_total").alias("grand_total"),
        ]
    return rows.select(*columns)


def dense_key(df: DataFrame, business_key: str, name: str, folder: TableFolder, table: str) -> DataFrame:
    """Surrogate key 1..n in the order of a unique business key."""
    ranked = global_rank(df, [F.col(business_key).asc_nulls_last()], folder, table, rank=name)
    return ranked.select(F.col(name).cast("bigint").alias(name), *df.columns)


def tile_of_rank(rank: Column, rows: Column, tiles: int) -> Column:
    """The ntile group of a 1-based rank: the first groups take the remainder."""
    base = F.floor(rows / F.lit(tiles)).cast("bigint")
    extra = (rows % F.lit(tiles)).cast("bigint")
    in_larger = rank <= extra * (base + 1)
    larger = F.ceil(rank / (base + 1))
    smaller = extra + F.ceil(F.try_divide(rank - extra * (base + 1), base))
    return F.when(in_larger, larger).otherwise(smaller).cast("int")
