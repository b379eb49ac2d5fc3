"""Raw tables by name, and the staged copies every later step reads."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import fixed_values as fixed
from tallyhouse import schemas
from tallyhouse.sources.records import read_csv
from tallyhouse.sources.tables import TableFolder

# Free text may hold line breaks. A file read with multiLine is not split, so
# it is switched on for the one table that needs it.
MULTILINE = {"order_reviews"}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Read a CSV with a header; columns are found by name, then cast.

    Types come from ``schema``, never from the data. Columns of the file that
    the schema does not name are not read; columns the file lacks are NULL.
    """
    text = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    present = set(text.columns)
    return text.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


@dataclass(frozen=True)
class RecordTable:
    """A raw table read record by record: calling it gives the good rows."""

    spark: SparkSession
    path: str
    schema: T.StructType
    folder: TableFolder

    def _split(self):
        return read_csv(self.spark, self.path, self.schema, self.folder, f"blocks-{uuid.uuid4().hex}")

    def __call__(self) -> DataFrame:
        return self._split().rows

    def rejected(self) -> DataFrame:
        return self._split().rejected


def record_sources(
    spark: SparkSession, template: str, folder: TableFolder, names: Mapping[str, str] | None = None
) -> dict[str, RecordTable]:
    """As ``csv_sources``, but large files are read in many tasks, quoted line breaks
    included, and a record that does not fit its table is set aside, not the build's end.

    ``folder`` takes one row per block of the files.
    """
    names = names or {}
    return {
        table: RecordTable(spark, template.format(name=names.get(table, table)), schema, folder)
        for table, schema in schemas.RAW.items()
    }


def csv_sources(
    spark: SparkSession, template: str, names: Mapping[str, str] | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """The nine raw tables from files found by a path template.

    ``template`` holds ``{name}``, for example ``/data/{name}.csv``; ``names``
    maps a raw table to its file name where the two differ.
    """
    names = names or {}

    def reader(table: str) -> Callable[[], DataFrame]:
        path = template.format(name=names.get(table, table))
        return lambda: scan_csv(spark, path, schemas.RAW[table], table in MULTILINE)

    return {table: reader(table) for table in schemas.RAW}


def staged(raw: DataFrame, snapshot_time: datetime = fixed.SNAPSHOT_TIME) -> DataFrame:
    """The raw rows plus the moment the snapshot was taken."""
    return raw.withColumn("ingestion_timestamp", F.lit(snapshot_time.isoformat(" ")).cast("timestamp_ntz"))


def register_views(
    sources: Mapping[str, Callable[[], DataFrame]],
    snapshot_time: datetime = fixed.SNAPSHOT_TIME,
) -> list[str]:
    """Register every staged table as a view ``stg_<name>``; nothing is copied."""
    names = []
    for table, read in sources.items():
        staged(read(), snapshot_time).createOrReplaceTempView(f"stg_{table}")
        names.append(f"stg_{table}")
    return names
