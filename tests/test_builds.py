"""What a build counts, keeps and throws away; questions answered from what it keeps."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.plans import checks, dashboard, filters, ordering, quality, sketches
from tallyhouse.plans.filters import Filters
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources import catalog
from tallyhouse.sources.staging import csv_sources
from tests.conftest import rows


@pytest.fixture
def edited(spark, raw_folder, tmp_path):
    """A warehouse over the raw files with some text replaced."""

    def make(name: str, old: str, new: str) -> Warehouse:
        folder = tmp_path / "raw"
        folder.mkdir()
        for f in raw_folder.iterdir():
            text = f.read_text(encoding="utf-8")
            assert f.stem != name or old in text
            (folder / f.name).write_text(text.replace(old, new) if f.stem == name else text, encoding="utf-8")
        return Warehouse(spark, csv_sources(spark, f"{folder}/{{name}}.csv"), str(tmp_path / "warehouse"))

    return make


def test_a_build_that_violates_what_is_declared_is_not_published(edited):
    wh = edited("order_reviews", "r2,o1,3,fine", "r2,o1,9,fine")
    report = wh.build(only_sound=True)
    assert not report.ok and not wh.ready()
    assert report.violations == (("fact_order_reviews", "accepted_values", "review_score", 1),)
    # Without the condition it is published, and the report tells the same.
    report = wh.build()
    assert report.ok and wh.ready() and len(report.violations) == 1
    assert rows(quality.accepted_violations(wh)) == [("fact_order_reviews", "review_score", "9", 1)]


def test_violations_counted_while_writing_are_those_found_afterwards(edited):
    # Delivered before it was ordered; a review without a score.
    wh = edited("orders", "2017-01-10 12:00:00", "2016-12-20 12:00:00")
    report = wh.build()
    found = {(t, c): n for t, k, c, n in report.violations if k == "negative_duration"}
    later = {("fact_order_items", c): n for c, n in rows(quality.negative_durations(wh))}
    assert found == later and found["fact_order_items", "delivery_days"] == 2
    assert not [v for v in report.violations if v[1] != "negative_duration"]


def test_sound_builds_pass_and_killed_ones_are_cleared(spark, raw_folder, tmp_path):
    sources = csv_sources(spark, f"{raw_folder}/{{name}}.csv")
    killed = Warehouse(spark, sources, str(tmp_path))
    assert killed["dim_sellers"].count() == 3  # a draft that nobody ends
    wh = Warehouse(spark, sources, str(tmp_path))
    for _ in range(3):
        assert wh.build(if_missing=False, only_sound=True).violations == ()
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("build-")]) == 2
    assert len(list((tmp_path / "published").glob("build-*"))) == 2


def test_tables_of_one_wave_do_not_need_each_other(wh):
    from tallyhouse import schemas
    from tallyhouse.plans.warehouse import WAVES

    assert sorted(name for wave in WAVES for name in wave) == sorted(schemas.WAREHOUSE_TABLES)


def test_kept_orders_are_found_once_for_all_questions(spark, raw_folder, tmp_path):
    wh = Warehouse(spark, csv_sources(spark, f"{raw_folder}/{{name}}.csv"), str(tmp_path))
    chosen = Filters(categories=("toys", "health_beauty"))
    assert rows(filters.kept_orders(wh, chosen)) == [("o1",), ("oX",)]
    assert not wh._remembered  # nothing is kept of a build that is not published
    assert wh.build().ok
    for question in (dashboard.delivery_vs_review, dashboard.freight_share_vs_review, dashboard.winning_method_by_month,
                     dashboard.method_mix_by_quarter, dashboard.instalments_by_category):
        plan = question(wh, chosen)._jdf.queryExecution().optimizedPlan().toString()
        assert "remembered" in plan or len(wh._remembered) == 1
    assert len(wh._remembered) == 1
    (kept,) = wh._remembered.values()
    assert rows(kept) == [("o1",), ("oX",)]
    # Another set is found anew, and so is the same one on another build.
    filters.kept_orders(wh, Filters(categories=("toys",)))
    assert len(wh._remembered) == 2
    assert wh.build(if_missing=False).ok and rows(filters.kept_orders(wh, chosen)) == [("o1",), ("oX",)]
    assert len(wh._remembered) == 3


def test_counts_and_bounds_come_from_footers(wh):
    plan = catalog.row_counts({n: wh.footers(n) for n in ("fact_order_items", "dim_sellers")})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedAggregation: [COUNT(*)]") >= 2
    assert dict(rows(plan))["fact_order_items"] == wh["fact_order_items"].count()
    bounds = filters.date_bounds(wh)
    assert "PushedAggregation: [MIN(purchase_date_key), MAX(purchase_date_key)]" in bounds._jdf.queryExecution().executedPlan().toString()
    assert rows(bounds) == [(date(2017, 1, 1), date(2018, 3, 1))]
    # The reader is chosen for that table only.
    assert "parquet" in wh.spark.conf.get("spark.sql.sources.useV1SourceList")


def test_sketches_merge_to_the_orders_of_a_range(wh):
    exact = rows(ordering.payment_methods_by_month(wh))
    assert rows(sketches.payment_methods_by_month(wh)) == exact
    days = Filters(start=date(2017, 1, 1), end=date(2017, 12, 31))
    assert rows(sketches.orders_by_hour(wh, days)) == rows(ordering.orders_by_hour(wh, days))
    with pytest.raises(ValueError):
        sketches.orders_by_hour(wh, Filters(regions=("Sul",)))
    text = sketches.orders_by_hour(wh, days)._jdf.queryExecution().optimizedPlan().toString()
    assert "fact_order_items" not in text and "price" not in text


def test_sketches_of_many_orders_are_within_their_error(spark):
    rows_ = spark.range(200_000).select(
        (F.col("id") % 60_000).alias("order_id"), (F.col("id") % 365).cast("int").alias("purchase_date_key"),
        F.lit(2017).alias("purchase_year"), (F.col("id") % 3).alias("hour"),
    )
    merged = {r["hour"]: r["orders"] for r in sketches._merged(sketches._sketched(rows_, "hour"), ("hour",)).collect()}
    exact = {r["hour"]: r["n"] for r in rows_.groupBy("hour").agg(F.countDistinct("order_id").alias("n")).collect()}
    assert all(abs(merged[h] - exact[h]) < 0.05 * exact[h] for h in exact)


def test_declared_values_are_the_agreed_ones():
    """Values stated once more, so that a change of the declarations is noticed."""
    assert fixed.REVIEW_SCORES == [1, 2, 3, 4, 5] or tuple(fixed.REVIEW_SCORES) == (1, 2, 3, 4, 5)
    assert set(fixed.REGIONS) >= {"Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul", "Unknown"}
    assert set(fixed.SIZE_BANDS_ACCEPTED) >= {"Small", "Medium", "Large"}
    assert {t: len(links) for t, links in checks.PARENTS.items()} == {
        "dim_customers": 1, "dim_sellers": 1, "fact_order_items": 11, "fact_order_payments": 5, "fact_order_reviews": 6,
    }
    assert sum(len(c) for c in checks.UNIQUE.values()) == 14
    assert checks.GRAINS["fact_order_reviews"] == ["review_id", "order_id"]
