"""Delimited files as records: quoted line breaks without one task per file, and rejects.

A line break inside quotes belongs to a value, so a line alone does not tell whether it
begins a record. Quotes come in pairs, and a doubled quote is a pair: a line begins a
record exactly if an even number of quotes precede it in its file. The file is read in
blocks by many tasks; the parity of each block is one bit, and the parity before a block
follows from those of the blocks before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.tables import TableFolder

QUOTE = '"'
_OPTIONS = {"sep": ",", "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"}
_MARK = "﻿"  # may stand before a header


@dataclass(frozen=True)
class Split:
    """Good rows, and those that were not: file, record, reasons."""

    rows: DataFrame
    rejected: DataFrame


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names, from the first record of the files."""
    reader = spark.read.option("header", True).option("multiLine", True)
    return reader.option("quote", QUOTE).option("escape", QUOTE).csv(path).columns


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the block it was read in, and its place.

    A file is cut into blocks of ``spark.sql.files.maxPartitionBytes`` at most. Places
    rise within a block.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        (F.length("value") - F.length(F.replace("value", F.lit(QUOTE)))).cast("long").alias("quotes"),
        "value",
    )


def _opened(lines: DataFrame, folder: TableFolder, name: str) -> DataFrame:
    """Per block: whether it begins inside quotes, where those end, the block they began in, and how lines end.

    One row per block of the input, written, so that Spark knows how small it is.
    """
    odd = F.col("quotes") % 2 == 1
    blocks = lines.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("parity"),
        F.min(F.when(odd, F.col("place"))).alias("turn"),
        F.min(F.struct("place", F.col("value").endswith("\r").alias("returned"))).getField("returned").alias("returned"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    seen = blocks.select(
        "file",
        "block",
        (F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2 == 1).alias("inside"),
        "turn",
        # Whether lines of the file end in a carriage return too, as its first one says.
        F.first("returned").over(Window.partitionBy("file").orderBy("block")).alias("returned"),
        # Quotes that are open where a block begins were opened by the last block that has a turn.
        F.last(F.when(F.col("turn").isNotNull(), F.col("block")), ignorenulls=True).over(earlier).alias("origin"),
    )
    return folder.write(name, seen)


def records(spark: SparkSession, path: str, folder: TableFolder, name: str) -> DataFrame:
    """(file, home, number, record): every record of the files as text, headers included.

    Lines go to the block their record began in, which takes one shuffle; the lines of a
    block are then counted through in order and joined. A block is bounded in size, so no
    file is one task. A record longer than a block is put together from all its blocks.
    Quotes must be balanced and stand around whole values, as RFC 4180 has it. Empty
    lines are no records.
    """
    lines = _lines(spark, path)
    opened = _opened(lines, folder, name)
    joined = lines.join(opened, ["file", "block"])
    carried = F.col("inside") & (F.col("turn").isNull() | (F.col("place") <= F.col("turn")))
    home = F.when(carried, F.col("origin")).otherwise(F.col("block"))
    value = F.when(F.col("returned"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    placed = joined.select("file", home.alias("home"), "block", "place", "quotes", value.alias("value"))
    order = Window.partitionBy("file", "home").orderBy("block", "place")
    upto, before = (order.rowsBetween(Window.unboundedPreceding, end) for end in (Window.currentRow, -1))
    # The first line that stays in its block is outside quotes, so counting begins with none.
    counted = placed.withColumn("_before", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    counted = counted.withColumn("_start", (F.col("_before") % 2 == 0).cast("long"))
    counted = counted.withColumn("number", F.sum("_start").over(upto))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    whole = counted.groupBy("file", "home", "number").agg(parts.alias("_parts"))
    text = F.array_join(F.transform("_parts", lambda p: p["value"]), "\n")
    return whole.select("file", "home", "number", text.alias("record")).filter("record != ''")


def _bad_cell(field: T.StructField) -> Column:
    """A reason if the cell holds what its type does not, else null."""
    cell = F.col(f"_cells.`{field.name}`")
    kind = field.dataType.simpleString()
    return F.when(cell.isNotNull() & cell.try_cast(field.dataType).isNull(), F.concat(F.lit(f"{field.name} is no {kind}: "), cell))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, folder: TableFolder, name: str
) -> Split:
    """Rows of the columns of ``schema``, and the records that do not fit it.

    Columns are found by name in the header; those the files lack are NULL. A record with
    more or fewer values than the header, or with a cell that is not of its type, is
    rejected whole with every reason: it costs one row and never the build. Both results
    read the files anew; nothing is kept but one row per block.
    """
    columns = _header(spark, path)
    names = [c.removeprefix(_MARK) for c in columns]
    cells = ", ".join(f"`{c}` string" for c in [*names, "_corrupt"])
    found = records(spark, path, folder, name)
    # The header is the first record of the first block of each file.
    found = found.filter((F.col("home") != 0) | (F.col("number") != 1))
    options = {**_OPTIONS, "columnNameOfCorruptRecord": "_corrupt"}
    parsed = found.select("file", "record", F.from_csv("record", cells, options).alias("_cells"))
    present = [f for f in schema if f.name in names]
    shape = F.when(F.col("_cells._corrupt").isNotNull(), F.lit("not as many values as the header has"))
    # Left out where there is none, so an empty array means a good row.
    parsed = parsed.withColumn("reasons", F.array_compact(F.array(shape, *[_bad_cell(f) for f in present])))
    good = parsed.filter(F.size("reasons") == 0).select(
        *[
            (F.col(f"_cells.`{f.name}`") if f.name in names else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
    bad = parsed.filter(F.size("reasons") > 0).select("file", "record", F.array_join("reasons", "; ").alias("reasons"))
    return Split(good, bad)
