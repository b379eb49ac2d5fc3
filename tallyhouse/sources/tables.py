"""Parquet tables in a folder every executor can reach."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T


class TableFolder:
    """Named Parquet tables below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._schemas: dict[str, T.StructType] = {}
        self._open: dict[str, DataFrame] = {}
        self.measured: dict[str, dict] = {}

    def path_of(self, name: str) -> str:
        return f"{self.path}/{name}"

    def below(self, name: str) -> TableFolder:
        return TableFolder(self.spark, self.path_of(name))

    def exists(self, name: str) -> bool:
        """True once a write of the table has been committed."""
        if name in self._open:
            return True
        files, marker = self._file(f"{self.path_of(name)}/_SUCCESS")
        return files.exists(marker)

    def _file(self, path: str):
        """The file system of a path, and the path as it wants it."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def mark(self, kind: str, name: str) -> None:
        """Leave an empty file ``name``; it is there at once or not at all."""
        files, place = self._file(f"{self.path_of(kind)}/{name}")
        files.create(place, False).close()

    def marks(self, kind: str) -> list[str]:
        """The names marked so far, in order."""
        files, place = self._file(self.path_of(kind))
        if not files.exists(place):
            return []
        return sorted(s.getPath().getName() for s in files.listStatus(place))

    def remove(self) -> None:
        """Delete the folder and all that is in it."""
        self._open.clear()
        files, place = self._file(self.path)
        files.delete(place, True)

    def write(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        measures: Sequence[Column] = (),
    ) -> DataFrame:
        """Write (replacing what is there) and return the table read back.

        ``cluster_by`` cuts the rows into ranges of those columns, one per task
        and file, and sorts each: rows that belong together lie together, and
        readers skip what is out of range. Ranges are balanced as long as the
        columns identify a row, however hot the first of them is; AQE joins
        neighbouring ranges of a small table. The first of them must order rows
        as ``partition_by`` does, so that a file spans few partitions.

        ``sort_by`` sorts the rows of each task as they come, without a shuffle.

        ``measures`` are aggregates counted in the job that writes, on the rows as they
        are written; ``measured`` has them afterwards.
        """
        self._open.pop(name, None)
        out = df
        if cluster_by:
            out = out.repartitionByRange(*cluster_by)
        if cluster_by or sort_by:
            out = out.sortWithinPartitions(*partition_by, *(cluster_by or sort_by))
        if measures:
            # Last of all: cutting ranges reads a part of the rows twice.
            seen = Observation(name)
            out = out.observe(seen, *measures)
        # Files are read far more often than written, and ids and amounts are digits.
        writer = out.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path_of(name))
        if measures:
            self.measured[name] = seen.get
        data = [f for f in df.schema if f.name not in partition_by]
        parts = [f for f in df.schema if f.name in partition_by]
        self._schemas[name] = T.StructType(
            [T.StructField(f.name, f.dataType, True) for f in data + parts]
        )
        return self.read(name)

    def footers(self, name: str) -> DataFrame:
        """The table through the reader that answers counts and bounds from file footers.

        Counts of all rows, and minima and maxima of numbers without a filter (but for one
        on the partitions), then read no rows at all. Which reader a table has is settled
        when it is opened, so the setting is put back at once.
        """
        conf, setting = self.spark.conf, "spark.sql.sources.useV1SourceList"
        conf.set("spark.sql.parquet.aggregatePushdown", "true")
        before = conf.get(setting)
        conf.set(setting, ",".join(kind for kind in before.split(",") if kind != "parquet"))
        try:
            return self.spark.read.parquet(self.path_of(name))
        finally:
            conf.set(setting, before)

    def read(self, name: str) -> DataFrame:
        """The table as last written here; its files are listed once."""
        if name not in self._open:
            reader = self.spark.read
            schema = self._schemas.get(name)
            if schema is not None:
                reader = reader.schema(schema)
            self._open[name] = reader.parquet(self.path_of(name))
        return self._open[name]
