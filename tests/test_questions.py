"""Questions against brute force over the small fixture, and awkward cases."""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.plans import dashboard, ordering, people, sales, shipping
from tallyhouse.plans.filters import Filters
from tests.conftest import rows


def test_top_category_breaks_ties_by_name(wh):
    assert rows(sales.top_category_by_month(wh)) == [
        (2017, 1, "January", "health_beauty", 100.0),
        (2017, 2, "February", "sem_nome", 0.0),
        (None, None, "Unknown", "health_beauty", 60.0),
    ]


def test_top_month_by_year(wh):
    assert rows(sales.top_month_by_year(wh), "year", "month", "revenue") == [
        (2017, 1, 200.0),
        (2018, 3, 50.0),
        (None, None, 80.0),
    ]


def test_yearly_revenue_of_top_categories(wh):
    assert rows(sales.yearly_revenue_of_top_categories(wh, limit=2)) == [
        (2017, "health_beauty", 100.0),
        (2017, "toys", 100.0),
        (None, "health_beauty", 60.0),
    ]
    ordered = dashboard.yearly_revenue_of_top_categories(wh, Filters(), limit=2)
    assert dict(rows(ordered, "category", "category_order")) == {"health_beauty": 1, "toys": 2}


def test_cancelled_counts_known_categories_of_cancelled_orders_only(wh):
    assert sales.cancelled_by_category(wh).count() == 0  # the only one is of no category


def test_delivery_and_freight_against_reviews(wh):
    assert rows(shipping.delivery_vs_review(wh)) == [(fixed.DELIVERY_DAY_LABELS[1], 1, 4.0)]
    # A basket of value 0 (o2) has no share and is left out.
    assert rows(shipping.freight_share_vs_review(wh)) == [(fixed.FREIGHT_PCT_LABELS[2], 1, 4.0)]


def test_freight_share_is_exact_at_the_edge(wh):
    cuts = shipping.freight_share_vs_review(wh, cuts=[22.75], labels=["below", "from"])
    assert rows(cuts) == [("from", 1, 4.0)]  # 45.50 of 200.00


def test_price_buckets(wh):
    assert rows(shipping.price_vs_freight(wh), "price_bucket", "items") == [
        (fixed.PRICE_LABELS[0], 2),
        (fixed.PRICE_LABELS[1], 2),
        (fixed.PRICE_LABELS[2], 2),
    ]


def test_late_rate_counts_the_promised_day(wh):
    assert rows(shipping.late_rate_by_size(wh)) == [
        ("Large", 1, 100.0, 0.0),
        ("Small", 1, 100.0, 0.0),
    ]


def test_photo_buckets(wh):
    assert rows(ordering.photos_vs_orders(wh)) == [
        (fixed.PHOTO_LABELS[0], 0, 1, 0.0),
        (fixed.PHOTO_LABELS[1], 1, 2, 160.0),
        (fixed.PHOTO_LABELS[4], 7, 1, 100.0),
    ]


def test_hours_and_peak(wh):
    assert rows(ordering.orders_by_hour(wh)) == [(0, 1), (5, 1), (10, 1), (23, 1)]
    assert rows(ordering.peak_hour(wh)) == [(0, 1)]


def test_instalments_by_main_category(wh):
    assert rows(ordering.instalments_by_category(wh, min_orders=1)) == [
        ("health_beauty", 1, 10.0, 100.0),
        ("sem_nome", 1, 0.0, 0.0),
    ]
    assert ordering.instalments_by_category(wh).count() == 0


def test_instalment_bands_and_baskets(wh):
    assert rows(ordering.instalment_bands(wh), "instalments", "payments") == [
        ("1", 1),
        ("2-3", 1),
        ("7-12", 1),
    ]
    assert rows(ordering.basket_vs_paid(wh)) == [
        ("2-3", 3, 1, 54.99, 55.0),
        ("7-12", 10, 1, 245.5, 245.5),
    ]


def test_quarter_mix(wh):
    mix = rows(dashboard.method_mix_by_quarter(wh, Filters()), "quarter_label", "payment_label", "share", "label")
    assert mix == [
        ("Q1/2017", "Credit card", 0.5, "1"),
        ("Q1/2017", "Voucher", 0.5, "1"),
        ("Q1/2018", "gift card", 1.0, "1"),
    ]
    hidden = ordering.method_mix_by_quarter(wh, min_share=0.6)
    assert sorted(r["label"] for r in hidden.collect()) == ["", "", "1"]


def test_repeat_customers_are_people(wh):
    # u1 bought through two customer ids and so is one repeat customer.
    # The order without a known customer is nobody's.
    assert rows(people.repeat_customers(wh)) == [("repeat", 2, 270.0)]


def test_unresolved_lines_are_reported_apart(wh):
    (row,) = people.unattributed_revenue(wh).collect()
    assert row["revenue_without_customer"] == 60.0
    fact = wh["fact_order_items"]
    assert row["lines_without_customer"] == fact.filter("customer_key = -1").count()
    assert row["lines_without_seller"] == fact.filter("seller_key = -1").count() > 0


def test_seller_pareto_rounds_the_number_of_sellers_up(wh, work):
    shares = rows(people.seller_pareto(wh, work), "top_pct", "sellers", "revenue")
    assert shares == [(1, 1, 160.0), (5, 1, 160.0), (10, 1, 160.0), (20, 1, 160.0)]
    running = rows(people.seller_running_share(wh, work), "seller_rank", "running_revenue")
    # Lines without a known seller (20.00) take no rank.
    assert running == [(1, 160.0), (2, 310.0)]


def test_rfm_shares_add_up(wh, work):
    segments = people.rfm_segments(wh, work).collect()
    assert sum(s["people"] for s in segments) == 2
    assert sum(s["share_pct"] for s in segments) == pytest.approx(100, abs=0.05)


def test_best_and_worst_categories(wh):
    out = people.review_by_category(wh, min_orders=1, each=1)
    assert rows(out) == [("best", "health_beauty", 1, 4.0), ("worst", "sem_nome", 1, 2.0)]


def test_monthly_growth(wh):
    assert rows(sales.monthly_revenue(wh)) == [
        ("2017-01", 200.0, None),
        ("2017-02", 0.0, -100.0),
        *[(f"2017-{m:02d}", 0.0, None) for m in range(3, 13)],
        ("2018-01", 0.0, None),
        ("2018-02", 0.0, None),
        ("2018-03", 50.0, None),
    ]


class Loaded:
    """Just enough of a warehouse: named tables."""

    def __init__(self, tables):
        self.tables = tables

    def __getitem__(self, name):
        return self.tables[name]


@pytest.mark.parametrize("hot", [False, True])
def test_category_pairs_against_brute_force(spark, hot):
    lines = [(o, (o * 7 + i * i) % 6) for o in range(60) for i in range(o % 5 + 1)]
    if hot:  # one order holds most lines
        lines += [(999, i % 6) for i in range(600)]
    items = spark.createDataFrame(lines, "order_id int, product_key int")
    products = spark.createDataFrame([(k, f"c{k}") for k in range(6)], "product_key int, category string")
    wh = Loaded({"fact_order_items": items, "dim_products": products})
    by_rows, by_orders = Counter(), Counter()
    grouped = {}
    for order, product in lines:
        grouped.setdefault(order, []).append(f"c{product}")
    for categories in grouped.values():
        pairs = [tuple(sorted(p)) for p in combinations(categories, 2) if p[0] != p[1]]
        by_rows.update(pairs)
        by_orders.update(set(pairs))
    for kind, expected in [("rows", by_rows), ("orders", by_orders)]:
        out = ordering.category_pairs(wh, count=kind, limit=1000)
        assert {(a, b): n for a, b, n in rows(out)} == dict(expected)
    with pytest.raises(ValueError):
        ordering.category_pairs(wh, count="baskets")


def test_averages_are_over_exact_sums(spark):
    from tallyhouse.functions import scalars as S

    df = spark.createDataFrame([("1.00",), ("1.01",)], "v string").select(F.col("v").cast("decimal(18,2)").alias("v"))
    assert df.agg(F.round(S.mean(F.col("v")), 2).alias("m")).first()["m"] == 1.01
