"""Helpers shared by the text operators."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import shared_folder

# Rows of a learned or stated table that may be broadcast, and its bytes as it is written.
# The rows are a bound for frames that are derived from a written table without arrays.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20


def library_for_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    Where it lies elsewhere on the workers (installed, or shipped with --py-files), the
    additional path does no harm.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [root, *paths]))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    library_for_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, removed when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    This cuts lineage in a way that survives a lost executor, and gives Spark the
    true size, by which it chooses between a broadcast and a shuffle.
    """
    path = f"{scratch(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(*frames: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for df in frames:
        folder = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder.getParent(), True)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of a stored table; 0 for a frame that was only derived from one."""
    if not hasattr(df, "stored_at"):
        return 0
    folder = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    fs = folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(folder).getLength()


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, marked for broadcast only if its bytes and rows were found to be few."""
    return F.broadcast(df) if stored_bytes(df) <= size and df.count() <= rows else df


def lower_az(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_key(text: Column) -> Column:
    """With doc_id, tells rows apart: rows equal in both are one document."""
    return F.xxhash64(F.lit(1), text)


def shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def with_spans(
    df: DataFrame,
    source: str,
    name: str,
    length: int,
    combine: Callable[[Column, Column], Column],
) -> DataFrame:
    """Add ``name``: ``combine`` over each run of ``length`` values of an array.

    Runs are doubled (1, 2, 4, ...) and put together from their powers of two, so an
    element costs log(length) steps. One column per step, else Catalyst would compute
    a step once for each use.
    """
    powers = {1: source}
    width = 1
    while width * 2 <= length:
        df = df.withColumn(
            f"{name}_{width * 2}",
            F.zip_with(powers[width], shifted(F.col(powers[width]), width), combine),
        )
        powers[width * 2] = f"{name}_{width * 2}"
        width *= 2
    have, at = width, powers[width]
    for power in sorted((p for p in powers if length & p and p != width), reverse=True):
        df = df.withColumn(
            f"{name}_to{have + power}",
            F.zip_with(at, shifted(F.col(powers[power]), have), combine),
        )
        have, at = have + power, f"{name}_to{have + power}"
    kept = F.slice(at, 1, F.greatest(F.size(source) - (length - 1), F.lit(0)))
    made = [c for c in df.columns if c.startswith(f"{name}_")]
    return df.withColumn(name, kept).drop(*made)


def same_key(left: DataFrame, right: DataFrame, names: Iterable[str]) -> Column:
    """Equality of the named columns in which null equals null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
