"""Pieces several questions share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S
from tallyhouse.operators.ranking import top_per_group
from tallyhouse.plans.filters import Filters, per_order, star, within_orders
from tallyhouse.plans.warehouse import Warehouse

def n_rows() -> Column:
    return F.count(F.lit(1))



def as_money(value: Column) -> Column:
    """An exact decimal sum, rounded to cents, as double."""
    return F.round(value, 2).cast("double")


def items_by(
    wh: Warehouse, filters: Filters | None, date: tuple[str, ...] = (), product: tuple[str, ...] = ()
) -> DataFrame:
    """Items (order-level filtering) with columns of their day and product."""
    roles: dict[str, tuple[str, str, dict[str, str]]] = {}
    if date:
        roles["purchase_date_key"] = ("dim_date", "date_key", {c: c for c in date})
    if product:
        roles["product_key"] = ("dim_products", "product_key", {c: c for c in product})
    return star(wh, within_orders(wh, "fact_order_items", filters), roles)


def known_category(df: DataFrame) -> DataFrame:
    return df.filter(F.col("category") != "unknown")


def score_per_order(wh: Warehouse, filters: Filters | None = None) -> DataFrame:
    """Reviews at order grain (an order may have several), to join with kept orders."""
    score = S.mean(F.col("review_score")).alias("review_score")
    return per_order(wh, "fact_order_reviews", filters, [score], meets_kept=True)


def dominant_category(wh: Warehouse, filters: Filters | None = None) -> DataFrame:
    """The category most lines of an order are in; ties go to the smaller name.

    Lines are counted per (order, category) first, so that even an order with
    very many lines reaches the second step as one row per category.
    """
    product = {"product_key": ("dim_products", "product_key", {"category": "category"})}
    counted = per_order(
        wh,
        "fact_order_items",
        filters,
        [n_rows().alias("lines")],
        groups=["category"],
        prepare=lambda rows: known_category(star(wh, rows, product)),
    )
    best = top_per_group(counted, ["order_id"], [F.desc("lines"), F.asc("category")])
    return best.select("order_id", "category")


def by_bucket(df: DataFrame, bucket: Column, name: str) -> DataFrame:
    """Orders and mean score per bucket, from rows at order grain."""
    return (
        df.groupBy(bucket.alias(name))
        .agg(
            n_rows().alias("orders"),
            F.round(S.mean(F.col("review_score")), 2).alias("avg_review_score"),
        )
        .orderBy(name)
    )
