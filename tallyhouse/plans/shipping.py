"""What drives the shipping cost, and how well deliveries keep their promise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import measures as M
from tallyhouse.functions import scalars as S
from tallyhouse.operators.ranking import top_rows
from tallyhouse.plans.common import n_rows, by_bucket, items_by, score_per_order
from tallyhouse.plans.filters import Filters, item_view, per_order, star
from tallyhouse.plans.warehouse import Warehouse

def avg_freight():
    return F.round(M.average("freight_value"), 2).alias("avg_freight")


def price_vs_freight(
    wh: Warehouse,
    filters: Filters = Filters(),
    cuts: Sequence = fixed.PRICE_CUTS,
    labels: Sequence[str] = fixed.PRICE_LABELS,
) -> DataFrame:
    bucket = S.bucketize(F.col("price"), cuts, labels).alias("price_bucket")
    items = item_view(wh, filters, ["price", "freight_value"])
    return items.groupBy(bucket).agg(n_rows().alias("items"), avg_freight()).orderBy("price_bucket")


def size_vs_freight(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    items = item_view(wh, filters, ["product_size_band", "freight_value"])
    return (
        items.filter(F.col("product_size_band") != "Unknown")
        .groupBy(F.col("product_size_band").alias("size_band"))
        .agg(n_rows().alias("items"), avg_freight())
        .orderBy("avg_freight", "size_band")
    )


def weight_vs_freight(
    wh: Warehouse,
    filters: Filters | None = None,
    cuts: Sequence = fixed.WEIGHT_CUTS,
    labels: Sequence[str] = fixed.WEIGHT_LABELS,
) -> DataFrame:
    weighed = items_by(wh, filters, product=("weight_g",)).filter(F.col("weight_g").isNotNull())
    bucket = S.bucketize(F.col("weight_g"), cuts, labels).alias("weight_bucket")
    return weighed.groupBy(bucket).agg(n_rows().alias("items"), avg_freight()).orderBy("weight_bucket")


def delivery_vs_review(
    wh: Warehouse,
    filters: Filters | None = None,
    cuts: Sequence = fixed.DELIVERY_DAY_CUTS,
    labels: Sequence[str] = fixed.DELIVERY_DAY_LABELS,
) -> DataFrame:
    """Drill-across: delivery days (items) against the score (reviews).

    Both facts are brought to order grain before they meet; joined row by row
    they would multiply.
    """
    delivered = per_order(
        wh,
        "fact_order_items",
        filters,
        [M.average("delivery_days").alias("delivery_days")],
        prepare=lambda rows: rows.filter(F.col("delivery_days").isNotNull()),
    )
    both = delivered.join(score_per_order(wh, filters), "order_id")
    return by_bucket(both, S.bucketize(F.col("delivery_days"), cuts, labels), "delivery_bucket")


def freight_share_vs_review(
    wh: Warehouse,
    filters: Filters | None = None,
    cuts: Sequence = fixed.FREIGHT_PCT_CUTS,
    labels: Sequence[str] = fixed.FREIGHT_PCT_LABELS,
) -> DataFrame:
    """Drill-across: freight in percent of the basket against the score."""
    baskets = per_order(
        wh,
        "fact_order_items",
        filters,
        [M.total("freight_value").alias("freight"), M.total("price").alias("basket")],
    ).filter(F.col("basket") > 0)
    both = baskets.join(score_per_order(wh, filters), "order_id")
    # freight / basket < cut / 100, without a division: exact on decimals.
    bucket = None
    for cut, label in zip(cuts, labels):
        below = F.col("freight") * 100 < F.col("basket") * cut
        bucket = F.when(below, label) if bucket is None else bucket.when(below, label)
    return by_bucket(both, bucket.otherwise(labels[-1]), "freight_pct_bucket")


def late_rate_by_size(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    """Late percentage and, among the late, mean days past the promise.

    A parcel that comes later on the promised day is late by the clock and 0
    days by the calendar; it counts in both.
    """
    items = item_view(
        wh, filters, ["product_size_band", "is_late_delivery", "delivery_delay_days"]
    ).filter((F.col("product_size_band") != "Unknown") & F.col("is_late_delivery").isNotNull())
    late_days = F.when(F.col("is_late_delivery") == 1, F.col("delivery_delay_days"))
    return (
        items.groupBy(F.col("product_size_band").alias("size_band"))
        .agg(
            n_rows().alias("items"),
            F.round(M.share("is_late_delivery"), 1).alias("late_rate_pct"),
            F.round(S.mean(late_days), 1).alias("avg_days_late"),
        )
        .orderBy(F.desc("late_rate_pct"), "size_band")
    )


def delivery_kpis(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    days = ["delivery_days", "seller_processing_days", "carrier_transit_days"]
    items = item_view(wh, filters, [*days, "is_late_delivery"])
    return items.agg(
        *[F.round(M.average(d), 2).alias(f"avg_{d}") for d in days],
        F.round(M.share("is_late_delivery"), 2).alias("late_rate_pct"),
    )


def processing_by_seller_state(wh: Warehouse, min_items: int = 50) -> DataFrame:
    items = star(
        wh, wh["fact_order_items"], {"seller_key": ("dim_sellers", "seller_key", {"state": "seller_state"})}
    )
    return (
        items.groupBy("seller_state")
        .agg(
            n_rows().alias("items"),
            F.round(M.average("seller_processing_days"), 2).alias("avg_processing_days"),
        )
        .filter(F.col("items") >= min_items)
        .orderBy(F.desc_nulls_last("avg_processing_days"), "seller_state")
    )


def late_rate_by_region(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    items = item_view(wh, filters, ["customer_region", "is_late_delivery"])
    return (
        items.filter(F.col("is_late_delivery").isNotNull())
        .groupBy(F.col("customer_region").alias("region"))
        .agg(n_rows().alias("items"), F.round(M.share("is_late_delivery"), 2).alias("late_rate_pct"))
        .orderBy(F.desc("late_rate_pct"), "region")
    )


def lateness_vs_review(
    wh: Warehouse,
    cuts: Sequence = fixed.LATENESS_CUTS,
    labels: Sequence[str] = fixed.LATENESS_LABELS,
) -> DataFrame:
    """Drill-across: how late an order's slowest item came, against the score."""
    lateness = (
        wh["fact_order_items"]
        .filter(F.col("delivery_delay_days").isNotNull())
        .groupBy("order_id")
        .agg(F.max("delivery_delay_days").alias("days_late"))
    )
    both = lateness.join(score_per_order(wh), "order_id")
    return by_bucket(both, S.bucketize(F.col("days_late"), cuts, labels), "lateness")


def distance_vs_review(
    wh: Warehouse,
    cuts: Sequence = fixed.DISTANCE_CUTS_KM,
    labels: Sequence[str] = fixed.DISTANCE_LABELS,
) -> DataFrame:
    """Drill-across: distance to an order's farthest seller against the score."""
    distances = (
        wh["fact_order_items"]
        .filter(F.col("buyer_seller_distance_km").isNotNull())
        .groupBy("order_id")
        .agg(F.max("buyer_seller_distance_km").alias("km"))
    )
    both = distances.join(score_per_order(wh), "order_id")
    return by_bucket(both, S.bucketize(F.col("km"), cuts, labels), "distance")


def freight_share_by_category(wh: Warehouse, min_items: int = 50, limit: int = 12) -> DataFrame:
    shared = (
        items_by(wh, None, product=("category",))
        .groupBy("category")
        .agg(
            n_rows().alias("items"),
            F.round(S.ratio(M.total("freight_value") * 100, M.total("price")), 2).alias(
                "freight_pct"
            ),
        )
        .filter(F.col("items") >= min_items)
    )
    return top_rows(shared, [F.desc_nulls_last("freight_pct"), F.asc("category")], limit)


def overall_item_ratios(wh: Warehouse) -> DataFrame:
    """Freight in percent of price, and price per item, over all items."""
    return wh["fact_order_items"].agg(
        F.round(S.ratio(M.total("freight_value") * 100, M.total("price")), 4).alias(
            "freight_pct_of_price"
        ),
        F.round(M.average("price"), 2).alias("avg_price_per_item"),
    )
