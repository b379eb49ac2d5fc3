"""The questions as a dashboard asks them: filtered, shorter, ready to draw."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import scalars as S
from tallyhouse.plans import ordering, sales, shipping
from tallyhouse.plans.filters import Filters
from tallyhouse.plans.warehouse import Warehouse


def _month_axis(df: DataFrame) -> DataFrame:
    """Add the key that puts months of different years in order."""
    return df.withColumn("month_sort", S.period_key(F.col("year"), F.col("month"), 100))


def top_category_by_month(wh: Warehouse, filters: Filters) -> DataFrame:
    return _month_axis(sales.top_category_by_month(wh, filters).drop("month_name"))


def top_month_by_year(wh: Warehouse, filters: Filters) -> DataFrame:
    return sales.top_month_by_year(wh, filters).drop("month_name")


def yearly_revenue_of_top_categories(wh: Warehouse, filters: Filters, limit: int = 8) -> DataFrame:
    """With ``category_order``: 1 for the category with the largest bars.

    At most ``limit`` categories times the years of the calendar are ordered.
    """
    yearly = sales.yearly_revenue_of_top_categories(wh, filters, limit)
    total = F.sum(F.col("revenue").cast("decimal(38,2)")).over(Window.partitionBy("category"))
    order = F.dense_rank().over(Window.orderBy(F.desc("_total"), F.asc("category")))
    return (
        yearly.withColumn("_total", total)
        .withColumn("category_order", order)
        .drop("_total")
        .orderBy("category_order", "year")
    )


def cancelled_by_category(wh: Warehouse, filters: Filters) -> DataFrame:
    return sales.cancelled_by_category(wh, filters, limit=10)


def delivery_vs_review(wh: Warehouse, filters: Filters) -> DataFrame:
    return shipping.delivery_vs_review(wh, filters, labels=fixed.DELIVERY_DAY_SHORT)


def price_vs_freight(wh: Warehouse, filters: Filters) -> DataFrame:
    return shipping.price_vs_freight(wh, filters)


def size_vs_freight(wh: Warehouse, filters: Filters) -> DataFrame:
    return shipping.size_vs_freight(wh, filters)


def weight_vs_freight(wh: Warehouse, filters: Filters) -> DataFrame:
    return shipping.weight_vs_freight(wh, filters, labels=fixed.WEIGHT_SHORT)


def freight_share_vs_review(wh: Warehouse, filters: Filters) -> DataFrame:
    return shipping.freight_share_vs_review(wh, filters, labels=fixed.FREIGHT_PCT_SHORT)


def winning_method_by_month(wh: Warehouse, filters: Filters) -> DataFrame:
    return _month_axis(ordering.winning_method_by_month(wh, filters))


def method_mix_by_quarter(wh: Warehouse, filters: Filters) -> DataFrame:
    return ordering.method_mix_by_quarter(wh, filters)


def quarter_axis(wh: Warehouse, filters: Filters) -> DataFrame:
    """The quarters that occur, in order of time, each once."""
    mix = method_mix_by_quarter(wh, filters)
    return mix.select("quarter_label", "quarter_sort").distinct().orderBy("quarter_sort")


def photos_vs_orders(wh: Warehouse, filters: Filters) -> DataFrame:
    return ordering.photos_vs_orders(wh, filters, labels=fixed.PHOTO_SHORT).drop("revenue")


def orders_by_hour(wh: Warehouse, filters: Filters) -> DataFrame:
    return ordering.orders_by_hour(wh, filters)


def peak_hour(wh: Warehouse, filters: Filters) -> DataFrame:
    return ordering.peak_hour(wh, filters)


def top_units_by_month(wh: Warehouse, filters: Filters) -> DataFrame:
    return _month_axis(sales.top_units_by_month(wh, filters).drop("month_name"))


def late_rate_by_size(wh: Warehouse, filters: Filters) -> DataFrame:
    return shipping.late_rate_by_size(wh, filters).drop("avg_days_late")


def instalments_by_category(wh: Warehouse, filters: Filters) -> DataFrame:
    return ordering.instalments_by_category(wh, filters, limit=10).drop("pct_installment_orders")
