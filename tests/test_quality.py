from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import quality
from tests.conftest import rows


def test_declared_checks_are_all_there(wh):
    report = rows(quality.report(wh), "check", "table", "column", "violations")
    per_check = {}
    for check, _, _, _ in report:
        per_check[check] = per_check.get(check, 0) + 1
    assert per_check == {
        "unique": 14,
        "not_null": 41,
        "relationships": 24,
        "accepted_values": 3,
        "grain": 3,
        "rows_kept": 3,
        "revenue": 1,
    }
    # The source holds one copy of a line, which the fact rightly does not.
    assert [r[:3] for r in report if r[3]] == [
        ("revenue", "fact_order_items", ""),
        ("rows_kept", "fact_order_items", ""),
    ]


def test_lost_rows_and_revenue(wh):
    assert rows(quality.lost_rows(wh)) == [("fact_order_items", 6, 7)]
    totals = quality.revenue_mismatch(wh).first()
    assert str(totals["warehouse_total"]) == "393.49" and str(totals["source_total"]) == "503.49"


def test_repeated_values_ignore_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, None), (3, None)], "k int, v string")
    found = quality.repeated_values({"t": df}, {"t": ["k", "v"]})
    assert rows(found) == [("t", "k", "2", 2), ("t", "v", "a", 2)]


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "k int, v string")
    assert rows(quality.null_counts(df, ["k", "v"])) == [("k", 1), ("v", 2)]


def test_orphans(spark):
    child = spark.createDataFrame([(1, 5), (9, 5), (9, None), (None, 6)], "a int, b int")
    parents = {"p": spark.createDataFrame([(1,)], "id int"), "q": spark.createDataFrame([(5,)], "id int")}
    found = quality.orphans({"c": child}, {"c": {"a": ("p", "id"), "b": ("q", "id")}}, parents.get)
    assert rows(found) == [("c", "a", 9, 2), ("c", "b", 6, 1)]


def test_outside(spark):
    df = spark.createDataFrame([(1,), (7,), (7,), (None,)], "score int")
    assert rows(quality.outside(df, "score", [1, 2, 3, 4, 5])) == [("7", 2)]


def test_duplicates(spark):
    df = spark.createDataFrame([("o", 1), ("o", 1), ("o", 2)], "order_id string, line int")
    assert rows(quality.duplicates(df, ["order_id", "line"])) == [("o", 1, 2)]


def test_negative_durations(wh):
    assert quality.negative_durations(wh).count() == 0


@pytest.mark.parametrize("hot", [True, False])
def test_hot_values_are_counted_in_full(spark, hot):
    df = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 7 if hot else F.col("id")).otherwise(F.col("id") + 10000).alias("k")
    )
    repeated = rows(quality.repeated_values({"t": df}, {"t": ["k"]}))
    assert repeated == ([("t", "k", "7", 3000)] if hot else [])


def test_large_parents_meet_counted_keys_not_rows(spark):
    """Without a broadcast the anti join comes after the counting, not before."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        child = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"))
        parents = {"p": spark.range(5).select("id"), "q": spark.range(3).select("id")}
        found = quality.orphans({"c": child}, {"c": {"a": ("p", "id"), "b": ("q", "id")}}, parents.get)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("LeftAnti") < plan.index("HashAggregate") < plan.index("Generate")
        assert rows(found) == [("c", "a", 5, 143), ("c", "a", 6, 142)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_without_gaps_are_compared_with_their_range(spark):
    parents = {
        "p": spark.createDataFrame([(-1,), (1,), (2,), (3,)], "id int"),
        "gap": spark.createDataFrame([(1,), (3,)], "id bigint"),
        "twice": spark.createDataFrame([(1,), (1,), (3,)], "id bigint"),
        "zero": spark.createDataFrame([(0,), (1,)], "id bigint"),
        "below": spark.createDataFrame([(-2,), (1,)], "id bigint"),
        "none": spark.createDataFrame([], "id bigint"),
        "far": spark.range(40_000, 140_000).select("id"),
    }
    dense = quality.dense_domains(parents.get, {(name, "id") for name in parents})
    assert dense == {("p", "id"): (1, 3, True), ("zero", "id"): (0, 1, False), ("far", "id"): (40_000, 139_999, False)}
    child = spark.createDataFrame(
        [(1, 1, 40_000), (4, 2, 39_999), (4, 3, 140_000), (-1, None, -1), (None, 3, None), (0, 2, 70_000)],
        "a int, b int, c bigint",
    )
    links = {"c": {"a": ("p", "id"), "b": ("gap", "id"), "c": ("far", "id")}}
    found = rows(quality.linked({"c": child}, links, parents.get))
    assert found == rows(quality.orphans({"c": child}, links, parents.get))
    assert ("c", "a", 4, 2) in found and ("c", "b", 2, 2) in found and ("c", "c", -1, 1) in found
    only_dense = quality.linked({"c": child}, {"c": {"a": ("p", "id")}}, parents.get)
    assert "Join" not in only_dense._jdf.queryExecution().executedPlan().toString()


def test_report_counts_what_a_broken_fact_holds(wh):
    """One pass over a table finds the same cells as the check of each kind."""
    broken = wh["fact_order_reviews"].withColumns(
        {"review_score": F.lit(9), "customer_key": F.lit(10**6).cast("bigint"), "order_status_key": F.lit(None).cast("int")}
    )
    n = broken.count()
    dense = quality.dense_domains(
        lambda name: wh[name], {link for links in quality.PARENTS.values() for link in links.values()}
    )
    assert ("dim_date", "date_key") not in dense and ("dim_customers", "customer_key") in dense
    found = {tuple(r)[:3]: r.violations for r in quality.cell_counts(broken, "fact_order_reviews", dense).collect()}
    wrong = {k[0::2]: v for k, v in found.items() if v}
    assert wrong == {
        ("accepted_values", "review_score"): 1,
        ("relationships", "customer_key"): n,
        ("not_null", "order_status_key"): n,
    }
