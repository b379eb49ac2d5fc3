"""Distinct orders over any range of days from sketches kept per day.

Counts of distinct orders do not add up over days or hours, so an exact count reads the
fact for every range asked for. A sketch of a day's orders is a few kilobytes at most,
and sketches of several days merge to that of all of them. The relative error of a count
is about 1.04 / sqrt(2 ** LOG_REGISTERS), 1.6 per cent; small sets are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.plans.filters import Filters, _in_days, star, within_payments
from tallyhouse.plans.warehouse import Warehouse

LOG_REGISTERS = 12


def _sketched(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy("purchase_date_key", "purchase_year", by).agg(
        F.hll_sketch_agg("order_id", LOG_REGISTERS).alias("sketch")
    )


def orders_per_day_and_method(wh: Warehouse) -> DataFrame:
    """purchase_date_key, purchase_year, payment_label, sketch; written once per build."""
    return wh.remembered("orders per day and method", lambda: _sketched(within_payments(wh, None), "payment_label"))


def orders_per_day_and_hour(wh: Warehouse) -> DataFrame:
    """purchase_date_key, purchase_year, purchase_hour, sketch; written once per build."""
    items = wh["fact_order_items"].filter(F.col("purchase_hour").isNotNull())
    return wh.remembered("orders per day and hour", lambda: _sketched(items, "purchase_hour"))


def _between(sketches: DataFrame, filters: Filters) -> DataFrame:
    if filters != Filters(start=filters.start, end=filters.end):
        raise ValueError("sketches are kept per day: only a range of days can be chosen")
    return _in_days(sketches, filters)


def _merged(df: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("orders"))


def payment_methods_by_month(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    """About how many orders per valid method and month; no fact is read for it."""
    period = {c: c for c in ("year", "month", "month_name")}
    days = star(wh, _between(orders_per_day_and_method(wh), filters), {"purchase_date_key": ("dim_date", "date_key", period)})
    return _merged(days, (*period, "payment_label")).orderBy(
        F.asc_nulls_last("year"), F.asc_nulls_last("month"), F.desc("orders"), "payment_label"
    )


def orders_by_hour(wh: Warehouse, filters: Filters = Filters()) -> DataFrame:
    """About how many orders per hour of purchase; no fact is read for it."""
    return _merged(_between(orders_per_day_and_hour(wh), filters), ("purchase_hour",)).orderBy("purchase_hour")


def against_exact(approximate: DataFrame, exact: DataFrame, by: tuple[str, ...], within: float = 0.05) -> DataFrame:
    """The exact counts, and whether the approximate ones are near them (two orders apart at least allowed)."""
    near = approximate.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("orders").alias("_orders"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    close = F.abs(F.col("_orders") - F.col("orders")) <= F.greatest(F.lit(2), F.col("orders") * within)
    return exact.join(near, same, "full").select(*by, "orders", F.coalesce(close, F.lit(False)).alias("close"))
