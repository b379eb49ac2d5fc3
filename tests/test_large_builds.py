"""What a build of facts shuffles, and that rows and checks stay whole without it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.operators.rows import dedup, dedup_few, hashes_again
from tallyhouse.plans import quality
from tallyhouse.plans.checks import GRAINS
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.staging import csv_sources
from tests.conftest import rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_stand_alone_are_not_shuffled(spark, work):
    alone = spark.range(0, 1000, 1, 4).select("id", F.col("id").alias("v"))
    assert "Exchange" not in plan_of(dedup_few(alone, ["id"], work))
    extra = spark.createDataFrame([(5, 1), (5, 9), (None, 7), (None, 3)], "id bigint, v bigint")
    few = alone.unionByName(extra)
    again, copies, every = hashes_again(few, ["id"], work)
    assert (again.count(), copies, every) == (2, 5, 1004)
    assert rows(dedup_few(few, ["id"], work)) == rows(dedup(few, ["id"]))
    plan = plan_of(dedup_few(few, ["id"], work))
    assert "LeftAnti, BuildRight" in plan and "SortMergeJoin" not in plan
    many = alone.unionByName(alone.withColumn("v", F.col("v") + 1))
    assert rows(dedup_few(many, ["id"], work)) == rows(dedup(many, ["id"])) == rows(alone)
    assert dedup_few(alone.limit(0), ["id"], work).count() == 0


def test_facts_are_written_as_joined(spark, raw_folder, tmp_path):
    """No ranges over the whole rows, and each file in the order of days."""
    wh = Warehouse(spark, csv_sources(spark, f"{raw_folder}/{{name}}.csv"), str(tmp_path))
    assert wh.build().ok
    for name in GRAINS:
        table = wh[name].withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
        for file in table.select("file").distinct().collect():
            own = table.filter(F.col("file") == file[0]).orderBy("at").collect()
            days = [(r["purchase_date_key"], r["order_id"]) for r in own]
            assert days == sorted(days)
    assert "zstd" in " ".join(p.name for p in tmp_path.rglob("*.parquet"))


def test_grain_violations_are_found_by_the_grain_itself(spark, work):
    class Given:
        def __init__(self):
            self.work = work

        def __getitem__(self, name):
            a, b = GRAINS[name]
            once = spark.range(0, 500, 1, 4).select(F.col("id").alias(a), (F.col("id") % 7).alias(b))
            return once.unionByName(once.filter(F.col(a).isin(3, 4))) if name == "fact_order_items" else once

    found = quality.grain_violations(Given())
    assert rows(found) == [("fact_order_items", "3 / 3", 2), ("fact_order_items", "4 / 4", 2)]
    # Rows whose hash stands alone are gone before they are grouped.
    assert "LeftSemi" in plan_of(found)
