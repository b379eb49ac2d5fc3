"""How people order and pay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import measures as M
from tallyhouse.functions import scalars as S
from tallyhouse.operators.ranking import share_of_group, top_per_group, top_rows
from tallyhouse.plans.common import n_rows, as_money, dominant_category, items_by
from tallyhouse.plans.filters import Filters, item_view, per_order, star, within_payments
from tallyhouse.plans.warehouse import Warehouse

def n_orders():
    return F.countDistinct("order_id").alias("orders")


def _payments_by(wh: Warehouse, filters: Filters | None, columns: tuple[str, ...]) -> DataFrame:
    return star(
        wh,
        within_payments(wh, filters),
        {"purchase_date_key": ("dim_date", "date_key", {c: c for c in columns})},
    )


def payment_methods_by_month(wh: Warehouse, filters: Filters | None = None) -> DataFrame:
    """Orders per valid method and month, the most used first."""
    period = ("year", "month", "month_name")
    counted = _payments_by(wh, filters, period).groupBy(*period, "payment_label").agg(n_orders())
    return counted.orderBy(
        F.asc_nulls_last("year"), F.asc_nulls_last("month"), F.desc("orders"), "payment_label"
    )


def winning_method_by_month(wh: Warehouse, filters: Filters | None = None) -> DataFrame:
    period = ("year", "month")
    counted = _payments_by(wh, filters, period).groupBy(*period, "payment_label").agg(n_orders())
    best = top_per_group(counted, period, [F.desc("orders"), F.asc("payment_label")])
    return best.orderBy(*period)


def method_mix_by_quarter(
    wh: Warehouse, filters: Filters | None = None, min_share: float = fixed.MIN_LABELLED_SHARE
) -> DataFrame:
    """Orders per method and quarter with each method's share.

    ``label`` is the number to print, empty where the share is too small to
    hold one. ``quarter_sort`` orders the quarters.
    """
    period = ("year", "quarter")
    counted = _payments_by(wh, filters, period).groupBy(*period, "payment_label").agg(n_orders())
    shared = share_of_group(counted, "orders", period, "share")
    quarter = F.concat(
        F.lit("Q"), F.col("quarter").cast("string"), F.lit("/"), F.col("year").cast("string")
    )
    shown = F.when(F.col("share") >= min_share, F.format_number("orders", 0)).otherwise("")
    return shared.select(
        *period,
        quarter.alias("quarter_label"),
        S.period_key(F.col("year"), F.col("quarter"), 10).alias("quarter_sort"),
        "payment_label",
        "orders",
        F.round("share", 6).alias("share"),
        shown.alias("label"),
    ).orderBy("quarter_sort", "payment_label")


def photos_vs_orders(
    wh: Warehouse,
    filters: Filters | None = None,
    cuts: Sequence = fixed.PHOTO_CUTS,
    labels: Sequence[str] = fixed.PHOTO_LABELS,
) -> DataFrame:
    shown = items_by(wh, filters, product=("photos_qty",)).filter(F.col("photos_qty").isNotNull())
    bucket = S.bucketize(F.col("photos_qty"), cuts, labels, closed="right", exact_head=True)
    return (
        shown.groupBy(bucket.alias("photo_bucket"))
        .agg(
            F.min("photos_qty").alias("sort_key"),
            n_orders(),
            as_money(M.total("price")).alias("revenue"),
        )
        .orderBy("sort_key", "photo_bucket")
    )


def orders_by_hour(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    items = item_view(wh, filters, ["order_id", "purchase_hour"])
    return (
        items.filter(F.col("purchase_hour").isNotNull())
        .groupBy("purchase_hour")
        .agg(n_orders())
        .orderBy("purchase_hour")
    )


def peak_hour(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    """The hour with the most orders; the earlier one when two are equal."""
    return top_rows(orders_by_hour(wh, filters), [F.desc("orders"), F.asc("purchase_hour")], 1)


def instalments_by_category(
    wh: Warehouse, filters: Filters | None = None, min_orders: int = 50, limit: int = 15
) -> DataFrame:
    """Drill-across: an order's main category against its instalments."""
    most = F.max("payment_installments").alias("instalments")
    plans = per_order(wh, "fact_order_payments", filters, [most], meets_kept=True)
    both = dominant_category(wh, filters).join(plans, "order_id")
    counted = (
        both.groupBy("category")
        .agg(
            n_rows().alias("orders"),
            F.round(S.mean(F.col("instalments")), 2).alias("avg_installments"),
            F.round(S.percent(S.flag(F.col("instalments") > 1)), 1).alias("pct_installment_orders"),
        )
        .filter(F.col("orders") >= min_orders)
    )
    return top_rows(counted, [F.desc_nulls_last("avg_installments"), F.asc("category")], limit)


def payment_method_summary(wh: Warehouse, filters: Filters | None = None) -> DataFrame:
    return (
        within_payments(wh, filters)
        .groupBy("payment_label")
        .agg(n_orders(), F.round(M.average("payment_value"), 2).alias("avg_payment_value"))
        .orderBy(F.desc("orders"), "payment_label")
    )


def _instalment_band(value: str, cuts: Sequence, labels: Sequence[str]):
    return S.bucketize(F.col(value), cuts, labels, closed="right")


def instalment_bands(
    wh: Warehouse,
    cuts: Sequence = fixed.INSTALMENT_CUTS,
    labels: Sequence[str] = fixed.INSTALMENT_LABELS,
) -> DataFrame:
    """Mean payment per band of instalments (payments without any are left out)."""
    paid = wh["fact_order_payments"].filter(F.col("payment_installments") >= 1)
    band = _instalment_band("payment_installments", cuts, labels)
    return (
        paid.groupBy(band.alias("instalments"))
        .agg(
            F.min("payment_installments").alias("sort_key"),
            n_rows().alias("payments"),
            F.round(M.average("payment_value"), 2).alias("avg_payment_value"),
        )
        .orderBy("sort_key")
    )


def basket_vs_paid(
    wh: Warehouse,
    cuts: Sequence = fixed.INSTALMENT_CUTS,
    labels: Sequence[str] = fixed.INSTALMENT_LABELS,
) -> DataFrame:
    """Drill-across: value ordered against value paid, by instalments."""
    baskets = (
        wh["fact_order_items"].groupBy("order_id").agg(M.total("total_item_value").alias("basket"))
    )
    paid = (
        wh["fact_order_payments"]
        .groupBy("order_id")
        .agg(M.total("payment_value").alias("paid"), F.max("payment_installments").alias("n"))
        .filter(F.col("n") >= 1)
    )
    band = _instalment_band("n", cuts, labels)
    return (
        baskets.join(paid, "order_id")
        .groupBy(band.alias("instalments"))
        .agg(
            F.min("n").alias("sort_key"),
            n_rows().alias("orders"),
            as_money(F.sum("basket")).alias("basket_value"),
            as_money(F.sum("paid")).alias("paid_value"),
        )
        .orderBy("sort_key")
    )


def split_payment_rate(wh: Warehouse) -> DataFrame:
    split = S.flag(F.col("is_split_payment"))
    return wh["fact_order_payments"].agg(
        n_rows().alias("payments"), F.round(S.percent(split), 4).alias("split_pct")
    )


def average_transaction_value(wh: Warehouse) -> DataFrame:
    return wh["fact_order_payments"].agg(
        n_rows().alias("payments"), F.round(M.average("payment_value"), 4).alias("avg_payment_value")
    )


def category_pairs(wh: Warehouse, count: str = "rows", limit: int = 12) -> DataFrame:
    """Categories bought together, each pair once (``a < b``).

    ``count="rows"`` counts pairs of lines, ``"orders"`` counts orders. Lines
    are first counted per order and category, and orders with the same counts
    are then merged into one basket with a weight. So no pair of lines is ever
    made: a basket yields one pair per two of its categories.
    """
    if count not in ("rows", "orders"):
        raise ValueError("count is 'rows' or 'orders'")
    lines = (
        items_by(wh, None, product=("category",))
        .groupBy("order_id", "category")
        .agg(n_rows().alias("n"))
    )
    entry = F.struct(F.col("category"), F.col("n"))
    baskets = (
        lines.groupBy("order_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("basket"))
        .filter(F.size("basket") > 1)
        .groupBy("basket")
        .agg(n_rows().alias("weight"))
    )
    pairs = baskets.select(
        "weight", "basket", F.posexplode("basket").alias("at", "a")
    ).select(
        "weight", "a", F.explode(F.expr("slice(basket, at + 2, size(basket))")).alias("b")
    )
    each = F.col("weight") if count == "orders" else F.col("weight") * F.col("a.n") * F.col("b.n")
    counted = pairs.groupBy(
        F.col("a.category").alias("category_a"), F.col("b.category").alias("category_b")
    ).agg(F.sum(each).alias("pairs"))
    return top_rows(counted, [F.desc("pairs"), F.asc("category_a"), F.asc("category_b")], limit)
