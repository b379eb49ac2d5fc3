"""Looking around in a warehouse: tables, sizes, columns, previews, export."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TABLE_NAME = T.StructType([T.StructField("table_name", T.StringType(), False)])
_COLUMN = T.StructType(
    [
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
    ]
)


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make tables visible to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession) -> DataFrame:
    """Names of all registered tables and views, sorted."""
    names = sorted({t.name for t in spark.catalog.listTables()})
    return spark.createDataFrame([(n,) for n in names], _TABLE_NAME)


def has_tables(spark: SparkSession, required: list[str]) -> bool:
    """True when every required table is registered."""
    return all(spark.catalog.tableExists(name) for name in required)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and, in the last row, of all of them: one job for all."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    # One row per table: the rollup adds the grand total.
    return (
        counts.rollup("table_name")
        .agg(F.sum("row_count").alias("row_count"))
        .select(F.coalesce("table_name", F.lit("(all tables)")).alias("table_name"), "row_count")
    )


def describe(df: DataFrame) -> DataFrame:
    """Position, name and type of every column (as many rows as columns)."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, start=1)]
    return df.sparkSession.createDataFrame(rows, _COLUMN)


def preview(df: DataFrame, rows: int = 100) -> DataFrame:
    return df.limit(rows)


def export_csv(df: DataFrame, path: str, rows: int | None = 100) -> str:
    """Write a preview (or, with ``rows=None``, everything) as CSV with header."""
    out = df if rows is None else preview(df, rows)
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def to_client(df: DataFrame, ready: bool = True) -> pd.DataFrame:
    """A small final result as pandas; an empty frame while nothing is built."""
    return df.toPandas() if ready else pd.DataFrame()
