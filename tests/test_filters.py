from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import dashboard, filters, ordering, sales
from tallyhouse.plans.filters import Filters
from tests.conftest import rows


def ids(df):
    return [r[0] for r in rows(df, "order_id")]


def test_none_empty_and_subset_mean_different_things(wh):
    everything = filters.item_view(wh)
    assert everything.columns == filters.ITEM_VIEW_COLUMNS and len(everything.columns) == 21
    assert everything.count() == 6
    assert filters.item_view(wh, Filters(categories=())).count() == 0
    assert ids(filters.item_view(wh, Filters(categories=("toys",)))) == ["o1"]
    # A strict subset leaves out the Unknown members, None keeps them.
    named = ("health_beauty", "toys", "sem_nome")
    assert len(ids(filters.item_view(wh, Filters(categories=named)))) == 4


def test_dates_are_inclusive_and_drop_the_unknown_day(wh):
    day = date(2017, 1, 1)
    assert ids(filters.item_view(wh, Filters(start=day, end=day))) == ["o1", "o1"]
    assert ids(filters.item_view(wh, Filters(start=date(2000, 1, 1)))) == ["o1", "o1", "o2", "o4"]
    assert ids(filters.item_view(wh, Filters(end=date(2017, 12, 31)))) == ["o1", "o1", "o2"]


def test_region_and_state(wh):
    assert ids(filters.item_view(wh, Filters(regions=("Sudeste",)))) == ["o1", "o1"]
    assert ids(filters.item_view(wh, Filters(customer_states=("RJ",)))) == ["o2", "o3", "o4"]


def test_item_level_and_order_level_differ_on_a_mixed_order(wh):
    toys = Filters(categories=("toys",))
    by_item = sales.kpi_sales(wh, toys).first()
    assert (by_item["revenue"], by_item["orders"], by_item["aov"]) == (100.0, 1, 100.0)
    kept = filters.within_orders(wh, "fact_order_items", toys)
    assert kept.count() == 2  # the other line of the order stays
    best = dashboard.top_category_by_month(wh, toys).first()
    assert best["top_category"] == "health_beauty"  # equal revenue: the smaller name


@pytest.mark.parametrize(
    "narrowing",
    [
        Filters(),
        Filters(start=date(2017, 1, 1), end=date(2017, 12, 31)),
        Filters(regions=("Sudeste", "Sul")),
        Filters(customer_states=("RJ",), start=date(2017, 1, 1)),
        Filters(regions=()),
        Filters(categories=("toys", "sem_nome")),
        Filters(categories=("toys",), regions=("Norte",)),
    ],
)
@pytest.mark.parametrize("fact", ["fact_order_items", "fact_order_payments", "fact_order_reviews"])
def test_order_level_filter_equals_the_semi_join(wh, narrowing, fact):
    plain = wh[fact].join(filters.item_view(wh, narrowing).select("order_id"), "order_id", "left_semi")
    quick = filters.within_orders(wh, fact, narrowing)
    assert quick.columns == wh[fact].columns
    grain = ["order_id", {"fact_order_items": "order_item_id", "fact_order_payments": "payment_sequential", "fact_order_reviews": "review_id"}[fact]]
    assert rows(quick, *grain) == rows(plain, *grain)


def test_narrow_view_joins_only_what_it_needs(wh):
    view = filters.item_view(wh, Filters(regions=("Sul",)), ["order_id", "price"])
    plan = view._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_date_range_reaches_the_scan(wh):
    view = filters.item_view(wh, Filters(date(2017, 1, 1), date(2017, 12, 31)), ["price"])
    plan = view._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "purchase_year" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(purchase_da" in scan
    assert "freight_value" not in scan.split("ReadSchema")[1]


def test_payment_filter_touches_payment_methods_only(wh):
    cards = Filters(payment_labels=("Credit card",))
    assert [r["payment_label"] for r in ordering.payment_methods_by_month(wh, cards).collect()] == ["Credit card"]
    labels = {r["payment_label"] for r in ordering.payment_methods_by_month(wh).collect()}
    assert labels == {"Credit card", "Voucher", "gift card"}
    assert sales.kpi_sales(wh, cards).first()["orders"] == 5


def test_options_and_bounds(wh):
    options = rows(filters.filter_options(wh))
    assert ("regions", "Sudeste") in options and ("categories", "toys") in options
    assert not any(o in ("Unknown", "unknown", "XX", "Not defined") for _, o in options)
    assert tuple(filters.date_bounds(wh).first()) == (date(2017, 1, 1), date(2018, 3, 1))


def test_picked():
    assert filters.picked(["a", "b"], ["b", "a"]) is None
    assert filters.picked(["a"], ["b", "a"]) == ("a",)
    assert filters.picked([], ["b", "a"]) == ()


def test_resolve_range():
    first, last = date(2016, 9, 4), date(2018, 10, 17)
    assert filters.resolve_range("all", first, last) == (first, last)
    assert filters.resolve_range(2016, first, last) == (first, date(2016, 12, 31))
    assert filters.resolve_range("2017", first, last) == (date(2017, 1, 1), date(2017, 12, 31))
    swapped = filters.resolve_range("custom", first, last, (date(2018, 1, 1), date(2017, 1, 1)))
    assert swapped == (date(2017, 1, 1), date(2018, 1, 1))
    with pytest.raises(ValueError):
        filters.resolve_range("custom", first, last)


def test_relabel(spark):
    df = spark.createDataFrame([("a_b", 1), ("c", 2), (None, 3)], "code string, v int")
    labels = spark.createDataFrame([("c", "See")], "code string, label string")
    assert rows(filters.relabel(df, "code", labels)) == [("None", 3), ("See", 2), ("a b", 1)]


def test_empty_kpis_are_zero(wh):
    nothing = sales.kpi_sales(wh, Filters(categories=())).first()
    assert tuple(nothing) == (0.0, 0, 0.0)
    assert filters.item_view(wh, Filters(categories=()), ["price"]).agg(F.count("*")).first()[0] == 0


def test_orders_are_grouped_before_they_are_filtered(spark, wh):
    """Raw lines are not shuffled by order just to be filtered and then grouped."""
    from tallyhouse.plans import shipping

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = shipping.freight_share_vs_review(wh, Filters(categories=("toys",)))
        plan = out._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("LeftSemi") :]
        assert plan.count("LeftSemi") == 1  # the items' side; the reviews meet it in the join
        assert below.index("partial_sum(price") < below.index("FileScan")
        assert out.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
