"""Customers, sellers and reviewers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import measures as M
from tallyhouse.functions import scalars as S
from tallyhouse.operators.ranking import global_rank, share_of_group, tile_of_rank
from tallyhouse.plans.common import n_rows, as_money, dominant_category, score_per_order
from tallyhouse.plans.filters import star
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.tables import TableFolder


def _per_person(wh: Warehouse) -> DataFrame:
    """Orders, revenue and last purchase per person, not per customer id.

    Lines whose customer is unresolved belong to nobody; see ``unattributed_revenue``.
    Summed per order and customer id before the customers are looked up: the
    join then moves orders, and a person with very many lines is small.
    """
    per_order = (
        wh["fact_order_items"]
        .filter(F.col("customer_key") != fixed.UNKNOWN_KEY)
        .groupBy("order_id", "customer_key")
        .agg(M.total("price").alias("price"), F.max("purchase_date_key").alias("day"))
    )
    known = star(
        wh,
        per_order,
        {"customer_key": ("dim_customers", "customer_key", {"customer_unique_id": "person"})},
    )
    # order_id is unique in per_order up to the customer, so rows are orders.
    return known.groupBy("person").agg(
        n_rows().alias("frequency"),
        F.sum("price").alias("monetary"),
        F.max("day").alias("last_day"),
    )


def repeat_customers(wh: Warehouse, repeat_from: int = 2) -> DataFrame:
    """People and revenue: one-time buyers against repeat buyers."""
    kind = F.when(F.col("frequency") >= repeat_from, "repeat").otherwise("one-time")
    return (
        _per_person(wh)
        .groupBy(kind.alias("customer_type"))
        .agg(n_rows().alias("people"), as_money(F.sum("monetary")).alias("revenue"))
        .orderBy("customer_type")
    )


def rfm_segments(wh: Warehouse, work: TableFolder, tiles: int = 5) -> DataFrame:
    """People in equal groups by money spent; group ``tiles`` spends most.

    The global rank is taken slice by slice, so no task sorts all people.
    """
    order = [F.asc("monetary"), F.asc("person")]
    ranked = global_rank(_per_person(wh), order, work, "rfm_rank")
    tiled = ranked.withColumn("tile", tile_of_rank(F.col("rank"), F.col("rows_total"), tiles))
    groups = tiled.groupBy(F.col("tile").alias("monetary_tile")).agg(
        n_rows().alias("people"),
        F.max("last_day").alias("last_purchase_key"),
        F.round(S.mean(F.col("frequency")), 2).alias("avg_frequency"),
        F.sum("monetary").alias("revenue"),
    )
    shared = share_of_group(groups.withColumn("_all", F.lit(1)), "revenue", ["_all"], "share")
    return shared.select(
        "monetary_tile",
        "people",
        "last_purchase_key",
        "avg_frequency",
        as_money(F.col("revenue")).alias("revenue"),
        F.round(F.col("share") * 100, 2).alias("share_pct"),
    ).orderBy("monetary_tile")


def unattributed_revenue(wh: Warehouse) -> DataFrame:
    """Lines and revenue whose customer or seller is unresolved, and so in no ranking here."""
    no_buyer = F.col("customer_key") == fixed.UNKNOWN_KEY
    no_seller = F.col("seller_key") == fixed.UNKNOWN_KEY
    return wh["fact_order_items"].agg(
        F.count(F.when(no_buyer, 1)).alias("lines_without_customer"),
        as_money(F.coalesce(F.sum(F.when(no_buyer, F.col("price"))), F.lit(0))).alias("revenue_without_customer"),
        F.count(F.when(no_seller, 1)).alias("lines_without_seller"),
        as_money(F.coalesce(F.sum(F.when(no_seller, F.col("price"))), F.lit(0))).alias("revenue_without_seller"),
    )


def _seller_revenue(wh: Warehouse) -> DataFrame:
    """Revenue per known seller; the Unknown member takes no rank."""
    known = wh["fact_order_items"].filter(F.col("seller_key") != fixed.UNKNOWN_KEY)
    return known.groupBy("seller_key").agg(M.total("price").alias("revenue"))


def seller_running_share(wh: Warehouse, work: TableFolder) -> DataFrame:
    """Sellers by revenue with the running total and its share of the whole."""
    order = [F.desc_nulls_last("revenue"), F.asc("seller_key")]
    ranked = global_rank(_seller_revenue(wh), order, work, "seller_rank", value="revenue")
    share = S.ratio(F.col("running_total") * 100, F.col("grand_total"))
    return ranked.select(
        "seller_key",
        F.col("rank").alias("seller_rank"),
        as_money(F.col("revenue")).alias("revenue"),
        as_money(F.col("running_total")).alias("running_revenue"),
        F.round(share, 4).alias("running_share_pct"),
    )


def seller_pareto(
    wh: Warehouse, work: TableFolder, percents: Sequence[int] = fixed.SELLER_TOP_PERCENTS
) -> DataFrame:
    """Share of revenue made by the top x percent of sellers (rounded up)."""
    order = [F.desc_nulls_last("revenue"), F.asc("seller_key")]
    ranked = global_rank(_seller_revenue(wh), order, work, "pareto_rank", value="revenue")
    cuts = F.explode(F.array(*[F.lit(p) for p in percents])).alias("top_pct")
    # Sellers are summed per cut inside each task; one row per cut is shuffled.
    inside = F.col("rank") * 100 < F.col("rows_total") * F.col("top_pct") + 100
    summed = (
        ranked.select("rank", "rows_total", "revenue", "grand_total", cuts)
        .groupBy("top_pct")
        .agg(
            F.sum(F.when(inside, 1).otherwise(0)).alias("sellers"),
            F.sum(F.when(inside, F.col("revenue"))).alias("revenue"),
            F.max("grand_total").alias("all_revenue"),
        )
    )
    return summed.select(
        "top_pct",
        "sellers",
        as_money(F.col("revenue")).alias("revenue"),
        F.round(S.ratio(F.col("revenue") * 100, F.col("all_revenue")), 2).alias("revenue_share_pct"),
    ).orderBy("top_pct")


def score_distribution(wh: Warehouse) -> DataFrame:
    return (
        wh["fact_order_reviews"]
        .groupBy("review_score")
        .agg(n_rows().alias("reviews"))
        .orderBy(F.asc_nulls_last("review_score"))
    )


def review_by_category(wh: Warehouse, min_orders: int = 50, each: int = 8) -> DataFrame:
    """Drill-across: the categories with the best and the worst mean score.

    A category near the middle of a short list is reported at both ends.
    """
    scored = (
        dominant_category(wh)
        .join(score_per_order(wh), "order_id")
        .groupBy("category")
        .agg(
            n_rows().alias("orders"),
            F.round(S.mean(F.col("review_score")), 2).alias("avg_review_score"),
        )
        .filter(F.col("orders") >= min_orders)
    )
    # Each category takes part in both contests, so the drill-across runs once.
    entered = scored.withColumn("side", F.explode(F.array(F.lit("best"), F.lit("worst"))))
    score = F.col("avg_review_score")
    order = [F.when(F.col("side") == "best", -score).otherwise(score), F.col("category")]
    place = F.row_number().over(Window.partitionBy("side").orderBy(*order))
    return (
        entered.withColumn("place", place)
        .filter(F.col("place") <= each)
        .orderBy("side", "place")
        .select("side", "category", "orders", "avg_review_score")
    )


def comment_rate(wh: Warehouse) -> DataFrame:
    return wh["fact_order_reviews"].agg(
        n_rows().alias("reviews"), F.round(M.share("has_comment"), 4).alias("comment_pct")
    )


def average_review_score(wh: Warehouse) -> DataFrame:
    return wh["fact_order_reviews"].agg(
        n_rows().alias("reviews"), F.round(M.average("review_score"), 4).alias("avg_review_score")
    )
