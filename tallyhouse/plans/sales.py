"""Sales over time and by category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import measures as M
from tallyhouse.functions import scalars as S
from tallyhouse.operators.ranking import share_of_group, top_per_group, top_rows
from tallyhouse.plans.common import n_rows, as_money, items_by, known_category
from tallyhouse.plans.filters import Filters, item_view
from tallyhouse.plans.warehouse import Warehouse

MONTH = ("year", "month", "month_name")


def top_category_by_month(wh: Warehouse, filters: Filters | None = None) -> DataFrame:
    """The category with the highest revenue of every month."""
    sales = (
        known_category(items_by(wh, filters, MONTH, ("category",)))
        .groupBy(*MONTH, "category")
        .agg(M.total("price").alias("revenue"))
    )
    best = top_per_group(sales, ["year", "month"], [F.desc_nulls_last("revenue"), F.asc("category")])
    return best.select(
        *MONTH, F.col("category").alias("top_category"), as_money(F.col("revenue")).alias("revenue")
    ).orderBy("year", "month")


def top_month_by_year(wh: Warehouse, filters: Filters | None = None) -> DataFrame:
    """The month with the highest revenue of every year."""
    sales = items_by(wh, filters, MONTH).groupBy(*MONTH).agg(M.total("price").alias("revenue"))
    best = top_per_group(sales, ["year"], [F.desc_nulls_last("revenue"), F.asc("month")])
    return best.select(*MONTH, as_money(F.col("revenue")).alias("revenue")).orderBy("year")


def yearly_revenue_of_top_categories(
    wh: Warehouse, filters: Filters | None = None, limit: int = 8
) -> DataFrame:
    """Revenue per year for the categories with the highest total revenue.

    The years of a category travel with its total, so the sales are aggregated
    once and never joined with themselves; the list is as long as the calendar
    has years.
    """
    yearly = (
        known_category(items_by(wh, filters, ("year",), ("category",)))
        .groupBy("year", "category")
        .agg(M.total("price").alias("revenue"))
    )
    totals = yearly.groupBy("category").agg(
        F.sum("revenue").alias("total"),
        F.collect_list(F.struct("year", "revenue")).alias("years"),
    )
    best = top_rows(totals, [F.desc_nulls_last("total"), F.asc("category")], limit)
    return (
        best.select("category", F.inline("years"))
        .select("year", "category", as_money(F.col("revenue")).alias("revenue"))
        .orderBy("category", "year")
    )


def cancelled_by_category(
    wh: Warehouse, filters: Filters | None = None, limit: int = 15
) -> DataFrame:
    """Items of cancelled orders per category (unavailable ones do not count)."""
    statuses = wh["dim_order_status"].filter(F.col("order_status") == "canceled")
    items = known_category(items_by(wh, filters, product=("category",)))
    counted = (
        items.join(statuses.select("order_status_key"), "order_status_key", "left_semi")
        .groupBy("category")
        .agg(n_rows().alias("cancelled_items"))
    )
    return top_rows(counted, [F.desc("cancelled_items"), F.asc("category")], limit)


def top_units_by_month(wh: Warehouse, filters: Filters | None = None) -> DataFrame:
    """The category with the most pieces sold in every month."""
    units = (
        known_category(items_by(wh, filters, MONTH, ("category",)))
        .groupBy(*MONTH, "category")
        .agg(n_rows().alias("units_sold"))
    )
    best = top_per_group(units, ["year", "month"], [F.desc("units_sold"), F.asc("category")])
    return best.select(*MONTH, F.col("category").alias("top_category"), "units_sold").orderBy(
        "year", "month"
    )


def kpi_sales(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    """Revenue, number of orders and revenue per order; zeros when empty."""
    totals = item_view(wh, filters, ["order_id", "price"]).agg(
        F.coalesce(M.total("price"), F.lit(0)).alias("revenue"),
        F.countDistinct("order_id").alias("orders"),
    )
    value = F.coalesce(S.ratio(F.col("revenue"), F.col("orders")), F.lit(0.0))
    return totals.select(
        as_money(F.col("revenue")).alias("revenue"), "orders", F.round(value, 2).alias("aov")
    )


def monthly_revenue(wh: Warehouse) -> DataFrame:
    """Revenue per month and growth over the month before, in percent.

    Every month from the first to the last one with sales has a row: one without
    sales has revenue 0, and after it there is no growth to state.
    """
    monthly = (
        items_by(wh, None, ("year_month",))
        .filter(F.col("year_month") != "Unknown")
        .groupBy("year_month")
        .agg(M.total("price").alias("revenue"))
    )
    # One row per month of the calendar: small enough for one ordered window.
    month = F.to_date(F.concat("year_month", F.lit("-01")))
    span = monthly.agg(F.min(month).alias("first"), F.max(month).alias("last")).filter("first is not null")
    months = span.select(F.explode(F.expr("sequence(first, last, interval 1 month)")).alias("first_day"))
    months = months.select(F.date_format("first_day", "yyyy-MM").alias("year_month"))
    filled = months.join(monthly, "year_month", "left").select(
        "year_month", F.coalesce("revenue", F.lit(0)).alias("revenue")
    )
    before = F.lag("revenue").over(Window.orderBy("year_month"))
    growth = S.ratio((F.col("revenue") - before) * 100, before)
    return filled.select(
        "year_month",
        as_money(F.col("revenue")).alias("revenue"),
        F.round(growth, 2).alias("growth_pct"),
    ).orderBy("year_month")


def top_categories(wh: Warehouse, limit: int = 10) -> DataFrame:
    sold = (
        items_by(wh, None, product=("category",))
        .groupBy("category")
        .agg(M.total("price").alias("revenue"), n_rows().alias("items"))
    )
    best = top_rows(sold, [F.desc_nulls_last("revenue"), F.asc("category")], limit)
    return best.select("category", as_money(F.col("revenue")).alias("revenue"), "items")


def revenue_by_region(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    """Revenue per customer region and its share of the whole."""
    regional = (
        item_view(wh, filters, ["customer_region", "price"])
        .groupBy(F.col("customer_region").alias("region"))
        .agg(M.total("price").alias("revenue"))
    )
    # One row per region: the whole is one small group.
    shared = share_of_group(regional.withColumn("_all", F.lit(1)), "revenue", ["_all"], "share")
    return shared.select(
        "region",
        as_money(F.col("revenue")).alias("revenue"),
        F.round(F.col("share") * 100, 2).alias("share_pct"),
    ).orderBy(F.desc("revenue"), "region")


def average_price_by_category(wh: Warehouse, min_items: int = 30, limit: int = 12) -> DataFrame:
    priced = (
        items_by(wh, None, product=("category",))
        .groupBy("category")
        .agg(n_rows().alias("items"), F.round(M.average("price"), 2).alias("avg_price"))
        .filter(F.col("items") >= min_items)
    )
    return top_rows(priced, [F.desc_nulls_last("avg_price"), F.asc("category")], limit)
