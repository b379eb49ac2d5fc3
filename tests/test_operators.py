from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators import ranking
from tallyhouse.operators.rows import dedup, resolve_fk, with_unknown
from tests.conftest import rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_the_first_in_a_total_order(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("a", None, "a"), ("b", None, None), ("b", None, None)],
        "k string, v int, w string",
    )
    assert rows(dedup(df, ["k"])) == [("a", 1, "y"), ("b", None, None)]
    assert rows(dedup(df.repartition(5), ["k"])) == rows(dedup(df, ["k"]))


def test_dedup_drops_copies_before_the_shuffle(spark):
    """A key that holds almost all rows must not travel to one task."""
    df = spark.range(0, 20000, 1, 4).select(
        F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("v")
    )
    out = dedup(df, ["k"])
    plan = plan_of(out)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange
    assert out.count() == 201
    assert out.filter("k = -1").first()["v"] == 1


def test_with_unknown_adds_one_typed_row(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "k int, n string, x double")
    out = with_unknown(df, {"k": -1, "n": "unknown"})
    assert rows(out) == [(-1, "unknown", None), (1, "a", 2.5)]
    assert out.dtypes == df.dtypes
    with pytest.raises(ValueError):
        with_unknown(df, {"other": 1})


def test_resolve_fk_keeps_every_row(spark):
    facts = spark.createDataFrame([("a", 1), ("zz", 2), (None, 3)], "code string, v int")
    dimension = spark.createDataFrame([("a", 7, 1.5)], "code string, key int, lat double")
    out = resolve_fk(facts, dimension, {"code": "code"}, {"key": -1, "lat": None})
    assert rows(out, "v", "key", "lat") == [(1, 7, 1.5), (2, -1, None), (3, -1, None)]


def test_dense_key_equals_the_global_window_without_one_big_task(spark, work):
    ids = [(f"{random.Random(i).random():.12f}-{i}",) for i in range(3000)]
    df = spark.createDataFrame(ids, "id string").repartition(7)
    keyed = ranking.dense_key(df, "id", "key", work, "ids")
    # One single partition, and what enters it is counted per slice before.
    plan = plan_of(keyed)
    assert plan.count("SinglePartition") == 1
    assert "HashAggregate(keys=[_slice" in plan[plan.index("SinglePartition") :]
    plain = df.select(F.row_number().over(Window.orderBy("id")).alias("key"), "id")
    assert rows(keyed) == rows(plain)


@pytest.mark.parametrize("partitions", [1, 3, 64, 200])
def test_global_rank_with_any_number_of_slices(spark, work, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sizes = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "2KB"}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(0, 5000, 1, 6).select(
            ((F.col("id") * 7919) % 5000).alias("id"), (F.col("id") % 13).alias("v")
        )
        ranked = ranking.global_rank(df, [F.desc("v"), F.asc("id")], work, f"p{partitions}")
        plain = df.select("id", F.row_number().over(Window.orderBy(F.desc("v"), "id")).alias("rank"))
        assert rows(ranked, "id", "rank") == rows(plain)
        slices = ranking.ordered_slices(df, [F.asc("id")], work, f"s{partitions}").before.count()
        assert slices == 1 if partitions == 1 else slices > 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        for key in sizes:
            spark.conf.unset(key)


def test_dense_key_survives_fewer_rows_than_slices(spark, work):
    df = spark.createDataFrame([("b",), ("a",)], "id string")
    assert rows(ranking.dense_key(df, "id", "key", work, "few")) == [(1, "a"), (2, "b")]
    none = df.filter("id = 'x'")
    assert ranking.dense_key(none, "id", "key", work, "none").count() == 0


@pytest.mark.parametrize("count", [1, 3, 5, 7, 23, 101])
def test_tiles_equal_ntile(spark, work, count):
    values = [(random.Random(i).randint(0, 10), i) for i in range(count)]
    df = spark.createDataFrame(values, "v int, id int")
    ranked = ranking.global_rank(df, [F.asc("v"), F.asc("id")], work, f"t{count}")
    tiles = ranked.select(
        "id", ranking.tile_of_rank(F.col("rank"), F.col("rows_total"), 5).alias("tile")
    )
    plain = df.select("id", F.ntile(5).over(Window.orderBy("v", "id")).alias("tile"))
    assert rows(tiles) == rows(plain)


def test_running_total_is_exact_and_skips_missing_values(spark, work):
    df = spark.createDataFrame(
        [(i, None if i % 9 == 0 else f"{i}.{i % 100:02d}") for i in range(1, 500)], "id int, v string"
    ).select("id", F.col("v").cast("decimal(18,2)").alias("v"))
    out = ranking.global_rank(df, [F.asc("id")], work, "run", value="v")
    window = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = df.select("id", F.sum("v").over(window).alias("running_total"))
    assert rows(out, "id", "running_total") == rows(plain)


def test_most_frequent_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("z", "b"), ("z", "a"), ("z", "b"), ("z", "a"), ("z", None), ("z", None), ("z", None), ("y", "q")],
        "g string, v string",
    )
    assert rows(ranking.most_frequent(df, ["g"], "v", "v")) == [("y", "q"), ("z", "a")]


def test_share_of_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 0)], "g string, v int")
    out = ranking.share_of_group(df, "v", ["g"], "share")
    assert rows(out) == [("a", 1, 0.25), ("a", 3, 0.75), ("b", 0, None)]


def test_top_rows_do_not_sort_everything(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v"))
    out = ranking.top_rows(df, [F.desc("v"), F.asc("id")], 3)
    assert "TakeOrderedAndProject" in plan_of(out)
    assert [r["id"] for r in out.collect()] == [6, 13, 20]


def test_a_hot_key_in_a_large_join_is_split(spark):
    """A third of all rows on one key: AQE cuts that partition of the join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("code"),
            F.col("id").alias("v"),
        )
        right = spark.range(0, 60000, 1, 4).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("code"),
            F.col("id").alias("key"),
        )
        out = resolve_fk(left, right, {"code": "code"}, {"key": -1}).groupBy().agg(
            F.count("*").alias("n"), F.sum((F.col("key") == 0).cast("int")).alias("hot")
        )
        assert rows(out) == [(60000, 20000)]
        assert "skew=true" in plan_of(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_two_rankings_of_one_name_can_be_read_in_any_order(spark, work):
    frames = [
        ranking.global_rank(spark.range(n), [F.col("id")], work, "same") for n in (5, 9)
    ]
    assert [frames[1].count(), frames[0].count()] == [9, 5]
    assert [frames[0].agg(F.max("rank")).first()[0], frames[1].agg(F.max("rank")).first()[0]] == [5, 9]


def test_zips_that_are_no_numbers_gather_no_names_in_one_buffer(spark):
    from tallyhouse.plans.dims import points_per_zip

    schema = (
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string"
    )
    odd = [(f"x{i}", 1.0, 2.0, f"town {i:04d}", "SP") for i in range(2000)]
    plain = [("7", 3.0, 4.0, "b", "RJ"), ("7", 5.0, 6.0, "a", "RJ"), ("8", 1.0, 1.0, None, None)]
    out = points_per_zip(spark.createDataFrame(odd + plain, schema))
    assert "mode(" not in out._jdf.queryExecution().toString()
    found = {r["zip_code_prefix"]: (r["city"], r["state"], r["latitude"]) for r in out.collect()}
    assert found == {None: ("town 0000", "SP", 1.0), 7: ("a", "RJ", 4.0), 8: (None, None, 1.0)}
