"""Every query by name: the questions, the tables behind them, the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas
from tallyhouse.adapters import tpch
from tallyhouse.functions import scalars as S
from tallyhouse.operators import ranking
from tallyhouse.operators.rows import dedup, resolve_fk
from tallyhouse.plans import dashboard, filters, ordering, people, quality, sales, shipping, sketches
from tallyhouse.plans.filters import Filters
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources import catalog
from tallyhouse.sources.records import read_csv
from tallyhouse.sources.staging import register_views, scan_csv, staged

Query = Callable[[SparkSession, str], DataFrame]

# One narrowing by order attributes only, one that also picks categories.
BY_ORDER = Filters(
    start=date(1996, 3, 1),
    end=date(1999, 6, 30),
    regions=("Nordeste", "Sudeste", "Sul"),
    customer_states=("BA", "CE", "MA", "MG", "PE", "PR", "RJ", "RS", "SP"),
)
BY_ITEM = Filters(
    start=date(1996, 3, 1),
    end=date(1999, 6, 30),
    regions=("Nordeste", "Sudeste", "Sul"),
    categories=("en_economy_2", "en_large_3", "en_medium_0", "en_small_3", "promo_4", "small_4"),
    payment_labels=("Credit card", "Debit card", "Voucher"),
)
REPEAT_FROM = 20


def _on_warehouse(plan: Callable[..., DataFrame], **arguments) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plan(tpch.warehouse(spark, folder), **arguments)

    return run


def _with_work(plan: Callable[..., DataFrame], name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        wh = tpch.warehouse(spark, folder)
        return plan(wh, wh.work.below(name))

    return run


def _on_given(build: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(lambda name: tpch.given_table(spark, folder, name))

    return run


def _table(name: str, **shown: Callable[[Column], Column]) -> Query:
    """A written table without its load time and partition column."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = tpch.warehouse(spark, folder)[name]
        keep = [c for c in df.columns if c not in ("insertion_timestamp",)]
        if name in schemas.FACTS:
            keep.remove("purchase_year")
        return df.select(*[shown[c](F.col(c)).alias(c) if c in shown else F.col(c) for c in keep])

    return run


def _two_places(value: Column) -> Column:
    return F.round(value, 2)


def _as_double(value: Column) -> Column:
    return value.cast("double")


def _fresh(wh: Warehouse, name: str) -> str:
    """A path of its own for each call: an earlier frame may not have been read yet."""
    return wh.work.path_of(f"csv/{name}-{uuid.uuid4().hex}")


def _as_records(wh: Warehouse, df: DataFrame, name: str) -> str:
    path = _fresh(wh, name)
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, escape='"', **kept).csv(path)
    return path


# --- operators on the given tables -------------------------------------------
def _quoted_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Free text with line breaks through a CSV file that is read in blocks."""
    wh = tpch.warehouse(spark, folder)
    docs = tpch.given_table(spark, folder, "documents")
    path = _as_records(wh, docs, "documents")
    return read_csv(spark, path, docs.schema, wh.work, f"blocks-{uuid.uuid4().hex}").rows


def _rejected_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which some have no date or no number; those come with a reason, the rest as rows."""
    wh = tpch.warehouse(spark, folder)
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    given = tpch.given_table(spark, folder, "orders").select(
        key.alias("order_id"),
        F.when(key % 97 == 5, "soon").otherwise(day).alias("ordered_on"),
        F.when(key % 89 == 3, "1,5").otherwise(F.col("o_totalprice").cast(schemas.MONEY).cast("string")).alias("total"),
    )
    schema = T.StructType(
        [
            T.StructField("order_id", T.LongType()),
            T.StructField("ordered_on", T.DateType()),
            T.StructField("total", schemas.MONEY),
        ]
    )
    found = read_csv(spark, _as_records(wh, given, "orders"), schema, wh.work, f"blocks-{uuid.uuid4().hex}")
    none = F.lit(None)
    good = found.rows.select("order_id", "ordered_on", _as_double(F.col("total")).alias("total"), none.cast("string").alias("reasons"))
    order = F.split_part("record", F.lit(","), F.lit(1)).cast("bigint")
    return good.unionByName(
        found.rejected.select(
            order.alias("order_id"), none.cast("date").alias("ordered_on"), none.cast("double").alias("total"), "reasons"
        )
    )


def _csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    wh = tpch.warehouse(spark, folder)
    path = _fresh(wh, "order_items")
    wh.sources["order_items"]().write.mode("overwrite").option("header", True).csv(path)
    # As the nine raw tables declare it, but the adapter's line ids are text.
    schema = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "order_item_id" else f.dataType)
            for f in schemas.RAW["order_items"]
        ]
    )
    read = scan_csv(spark, path, schema)
    return read.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        _as_double(F.col("price")).alias("price"),
        _as_double(F.col("freight_value")).alias("freight_value"),
    )


def _export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    wh = tpch.warehouse(spark, folder)
    products = wh["dim_products"]
    path = catalog.export_csv(products, _fresh(wh, "dim_products"), rows=None)
    return scan_csv(spark, path, products.schema)


def _marked_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The category names through a CSV file that begins with a byte order mark."""
    wh = tpch.warehouse(spark, folder)
    names = wh.sources["category_translation"]()
    path = _fresh(wh, "category_translation")
    # One file, as the lookup is: one row per category.
    marked = names.withColumnRenamed(names.columns[0], "\ufeff" + names.columns[0])
    marked.coalesce(1).write.option("header", True).csv(path)
    return scan_csv(spark, path, schemas.RAW["category_translation"])


def _sketched_methods(wh: Warehouse) -> DataFrame:
    by = ("year", "month", "month_name", "payment_label")
    return sketches.against_exact(sketches.payment_methods_by_month(wh), ordering.payment_methods_by_month(wh), by)


def _sketched_hours(wh: Warehouse) -> DataFrame:
    days = Filters(start=BY_ORDER.start, end=BY_ORDER.end)
    return sketches.against_exact(sketches.orders_by_hour(wh, days), ordering.orders_by_hour(wh, days), ("purchase_hour",))


def _staged_view(spark: SparkSession, folder: str) -> DataFrame:
    """Staged orders asked for by the name of their view."""
    register_views(tpch.sources(spark, folder))
    return spark.sql("select order_status, count(*) as orders from stg_orders group by order_status")


def _preview(wh: Warehouse) -> DataFrame:
    return catalog.preview(wh["dim_customers"].orderBy("customer_key"), 50)


def _range_presets(wh: Warehouse) -> DataFrame:
    """Items within each range of days that can be chosen by name."""
    first, last = date(1995, 1, 1), date(2001, 12, 31)
    chosen = {"all": ("all", None), "1997": (1997, None), "2001": ("2001", None)}
    chosen["custom"] = ("custom", (date(1998, 6, 30), date(1998, 2, 1)))
    counts = None
    for name, (preset, days) in chosen.items():
        start, end = filters.resolve_range(preset, first, last, days)
        items = filters.item_view(wh, Filters(start=start, end=end), ["order_id"])
        one = items.agg(F.count(F.lit(1)).alias("items")).select(F.lit(name).alias("preset"), "items")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def _staged_orders(spark: SparkSession, folder: str) -> DataFrame:
    return staged(tpch.sources(spark, folder)["orders"]())


def _warehouse_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    wh = tpch.warehouse(spark, folder)
    return catalog.row_counts({name: wh.footers(name) for name in schemas.WAREHOUSE_TABLES})


def _bucketize_prices(t) -> DataFrame:
    bucket = S.bucketize(
        F.col("o_totalprice"), [1000, 50000, 200000], ["a", "b", "c", "d"], closed="right"
    )
    return t("orders").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("orders"))


def _priority_labels(t) -> DataFrame:
    word = F.col("o_orderpriority")
    label = S.label_map(word, tpch.METHOD_OF, S.plain_words(F.lower(word)))
    return t("orders").groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("orders"))


def _late_shipments(t) -> DataFrame:
    """Three-valued flag against a promise of 21 days; no date on 'P' orders."""
    shipped = F.when(F.col("o_orderstatus") != "P", F.col("l_shipdate"))
    promise = F.col("o_orderdate") + F.make_dt_interval(F.lit(21))
    return (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .groupBy(S.late_flag(shipped, promise).alias("is_late"))
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.sum(S.days_between(promise, shipped)).alias("delay_days"),
        )
    )


def _enriched_events(t) -> DataFrame:
    """Left enrichment: every event is kept, with or without an order."""
    orders = t("orders").select("o_orderkey", "o_orderstatus")
    return (
        t("events")
        .join(orders, F.col("user_id") * 40 == F.col("o_orderkey"), "left")
        .groupBy(F.coalesce("o_orderstatus", F.lit("none")).alias("status"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def _resolved_customers(t) -> DataFrame:
    """Key resolution against a partial dimension: the rest gets -1."""
    half = t("customer").filter(F.col("c_nationkey") < 12)
    resolved = resolve_fk(t("orders"), half, {"o_custkey": "c_custkey"}, {"c_nationkey": -1})
    return resolved.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("orders"))


def _date_roles(wh: Warehouse) -> DataFrame:
    """The date dimension in two roles at once."""
    return (
        filters.star(
            wh,
            wh["fact_order_items"],
            {
                "purchase_date_key": ("dim_date", "date_key", {"year_quarter": "purchased_in"}),
                "delivered_date_key": ("dim_date", "date_key", {"year_quarter": "delivered_in"}),
            },
        )
        .groupBy("purchased_in", "delivered_in")
        .agg(F.count(F.lit(1)).alias("items"))
    )


def _joined_date_keys(t) -> DataFrame:
    """Join-free date keys against a calendar that does not hold every day."""
    key = S.date_key(F.col("l_shipdate"), date(1996, 1, 1), date(1998, 12, 31))
    return t("lineitem").groupBy(key.alias("date_key")).agg(F.count(F.lit(1)).alias("items"))


def _kept_lines(t) -> DataFrame:
    """Semi-join: lines of urgent orders."""
    urgent = t("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    kept = t("lineitem").join(urgent, "l_orderkey", "left_semi")
    return kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("items"),
        F.countDistinct("l_orderkey").alias("orders"),
    )


def _orphan_users(t) -> DataFrame:
    """Anti-join on distinct keys: parts and suppliers outside a partial parent."""
    tables = {
        "part": lambda: t("part").filter(F.col("p_size") < 25),
        "supplier": lambda: t("supplier").filter(F.col("s_nationkey") < 20),
    }
    links = {"l_partkey": ("part", "p_partkey"), "l_suppkey": ("supplier", "s_suppkey")}
    return quality.orphans(
        {"lineitem": t("lineitem")}, {"lineitem": links}, lambda name: tables[name]()
    )


def _orphans_by_range(t) -> DataFrame:
    """Users against all suppliers, whose keys have no gaps, and lines against some, whose keys have."""
    tables = {"all": lambda: t("supplier"), "some": lambda: t("supplier").filter(F.col("s_nationkey") < 20)}
    links = {"events": {"user_id": ("all", "s_suppkey")}, "lineitem": {"l_suppkey": ("some", "s_suppkey")}}
    return quality.linked({name: t(name) for name in links}, links, lambda name: tables[name]())


def _top_event_type(t) -> DataFrame:
    return ranking.most_frequent(t("events"), ["user_id"], "event_type", "event_type")


def _flag_percentages(t) -> DataFrame:
    returned = S.flag(F.col("l_returnflag") == "R")
    charge = F.col("l_extendedprice").cast(schemas.MONEY)
    taxed = charge * F.col("l_tax").cast("decimal(6,2)")
    return (
        t("lineitem")
        .groupBy("l_linestatus")
        .agg(
            F.round(S.percent(returned), 4).alias("returned_pct"),
            F.round(S.ratio(F.sum(taxed) * 100, F.sum(charge)), 4).alias("tax_pct"),
            F.round(S.mean(F.when(F.col("l_returnflag") == "R", charge)), 2).alias("avg_returned"),
        )
    )


def _grain_dedup(t) -> DataFrame:
    lines = t("lineitem")
    return dedup(lines, ["l_orderkey", "l_linenumber"])


def _dense_order_keys(spark: SparkSession, folder: str) -> DataFrame:
    wh = tpch.warehouse(spark, folder)
    ids = tpch.given_table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id")
    )
    return ranking.dense_key(ids, "order_id", "order_key", wh.work, "dense_order_keys")


def _customer_tiles(spark: SparkSession, folder: str) -> DataFrame:
    wh = tpch.warehouse(spark, folder)
    customers = tpch.given_table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    ranked = ranking.global_rank(
        customers, [F.asc("c_acctbal"), F.asc("c_custkey")], wh.work, "customer_tiles"
    )
    tile = ranking.tile_of_rank(F.col("rank"), F.col("rows_total"), 7)
    return ranked.select("c_custkey", F.col("rank").alias("place"), tile.alias("tile"))


def _running_order_value(spark: SparkSession, folder: str) -> DataFrame:
    wh = tpch.warehouse(spark, folder)
    orders = tpch.given_table(spark, folder, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").cast(schemas.MONEY).alias("value")
    )
    ranked = ranking.global_rank(
        orders, [F.asc("o_orderdate"), F.asc("o_orderkey")], wh.work, "running_value", value="value"
    )
    return ranked.select("o_orderkey", _as_double(F.col("running_total")).alias("running_total"))


def _status_share(t) -> DataFrame:
    counted = t("orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders")
    )
    shared = ranking.share_of_group(counted, "orders", ["o_orderpriority"], "share")
    return shared.withColumn("share", F.round("share", 6))


def _response_hours(t) -> DataFrame:
    start = F.col("ts") - F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("event_id") % 300).cast("int")
    )
    return t("events").groupBy(S.hour_boundaries(start, F.col("ts")).alias("hours")).agg(
        F.count(F.lit(1)).alias("events")
    )


def _calendar_in_use(wh: Warehouse) -> DataFrame:
    """Every day of the calendar with the items bought on it."""
    bought = (
        wh["fact_order_items"]
        .groupBy(F.col("purchase_date_key").alias("date_key"))
        .agg(F.count(F.lit(1)).alias("items"))
    )
    days = wh["dim_date"].join(bought, "date_key", "left")
    return days.withColumn("items", F.coalesce("items", F.lit(0)))


def _relabelled_statuses(wh: Warehouse) -> DataFrame:
    """Statuses by their labels where they have one, their own words otherwise."""
    labels = wh["dim_order_status"].filter("is_cancelled").select("order_status", "status_label")
    shown = wh["dim_order_status"].filter("order_status_key > 0").select("order_status_key", "order_status")
    counted = (
        wh["fact_order_items"]
        .groupBy("order_status_key")
        .agg(F.count(F.lit(1)).alias("items"))
        .join(shown, "order_status_key")
        .select("order_status", "items")
    )
    return filters.relabel(counted, "order_status", labels)


def _report_on_duplicates(t) -> DataFrame:
    return quality.duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"])


def _outside_values(t) -> DataFrame:
    return quality.outside(t("events"), "event_type", ["click", "view"])


def _null_payment_parts(wh: Warehouse) -> DataFrame:
    """NULL counts over columns that may well be NULL."""
    return quality.null_counts(
        wh["fact_order_items"],
        ["price", "delivery_days", "buyer_seller_distance_km", "is_late_delivery"],
    )


QUERIES: dict[str, Query] = {
    # sources and sinks
    "a01_csv_scan": _csv_roundtrip,
    "a01q_quoted_lines": _quoted_lines,
    "a01r_rejected_cells": _rejected_cells,
    "a02_marked_lookup": _marked_lookup,
    "a03_staged_orders": _staged_orders,
    "a04_staged_view": _staged_view,
    "a10_row_counts": _warehouse_row_counts,
    "a12_preview": _on_warehouse(_preview),
    "a13_export_csv": _export_roundtrip,
    # operators
    "b04_bucketize": _on_given(_bucketize_prices),
    "b05_label_map": _on_given(_priority_labels),
    "b07_three_valued_flag": _on_given(_late_shipments),
    "c01_left_enrichment": _on_given(_enriched_events),
    "c03_resolve_key": _on_given(_resolved_customers),
    "c04_date_roles": _on_warehouse(_date_roles),
    "c06_semi_join": _on_given(_kept_lines),
    "c11_orphans": _on_given(_orphan_users),
    "c11d_orphans_by_range": _on_given(_orphans_by_range),
    "d06_most_frequent": _on_given(_top_event_type),
    "d07_ratios": _on_given(_flag_percentages),
    "e01_dedup": _on_given(_grain_dedup),
    "e02_dense_key": _dense_order_keys,
    "e05_share_of_group": _on_given(_status_share),
    "e06_tiles": _customer_tiles,
    "e07_running_total": _running_order_value,
    "h16_hour_boundaries": _on_given(_response_hours),
    # dimensions and facts
    "i01_dim_date": _on_warehouse(_calendar_in_use),
    "i02_dim_geography": _table("dim_geography", latitude=lambda c: F.round(c, 6), longitude=lambda c: F.round(c, 6)),
    "i03_dim_customers": _table("dim_customers"),
    "i04_dim_sellers": _table("dim_sellers"),
    "i05_dim_products": _table("dim_products"),
    "i06_dim_order_status": _table("dim_order_status"),
    "i07_dim_payment_type": _table("dim_payment_type"),
    "i08_fact_order_items": _table(
        "fact_order_items",
        price=_as_double,
        freight_value=_as_double,
        total_item_value=_as_double,
        buyer_seller_distance_km=_two_places,
    ),
    "i10_date_keys": _on_given(_joined_date_keys),
    "i11_fact_order_payments": _table(
        "fact_order_payments", payment_value=_as_double, instalment_amount=_as_double
    ),
    "i12_fact_order_reviews": _table("fact_order_reviews"),
    # business questions
    "q01_top_category_by_month": _on_warehouse(sales.top_category_by_month),
    "q02_top_month_by_year": _on_warehouse(sales.top_month_by_year),
    "q03_yearly_revenue_top8": _on_warehouse(sales.yearly_revenue_of_top_categories),
    "q04_cancelled_by_category": _on_warehouse(sales.cancelled_by_category),
    "q05_delivery_vs_review": _on_warehouse(shipping.delivery_vs_review),
    "q06_price_vs_freight": _on_warehouse(shipping.price_vs_freight),
    "q07_size_vs_freight": _on_warehouse(shipping.size_vs_freight),
    "q08_weight_vs_freight": _on_warehouse(shipping.weight_vs_freight),
    "q09_freight_pct_vs_review": _on_warehouse(shipping.freight_share_vs_review),
    "q10_payment_methods_by_month": _on_warehouse(ordering.payment_methods_by_month),
    "q10h_methods_by_month_sketched": _on_warehouse(_sketched_methods),
    "q11_photos_vs_orders": _on_warehouse(ordering.photos_vs_orders),
    "q12_orders_by_hour": _on_warehouse(ordering.orders_by_hour),
    "q12h_orders_by_hour_sketched": _on_warehouse(_sketched_hours),
    "q13_top_units_by_month": _on_warehouse(sales.top_units_by_month),
    "q14_late_rate_by_size": _on_warehouse(shipping.late_rate_by_size),
    "q15_instalments_by_category": _on_warehouse(ordering.instalments_by_category),
    # filters and what a dashboard needs besides the questions
    "k01_kpi_sales": _on_warehouse(sales.kpi_sales),
    "k01f_kpi_sales_filtered": _on_warehouse(sales.kpi_sales, filters=BY_ITEM),
    "k01e_kpi_sales_nothing_chosen": _on_warehouse(sales.kpi_sales, filters=Filters(categories=())),
    "k02_filter_options": _on_warehouse(filters.filter_options),
    "k03_date_bounds": _on_warehouse(filters.date_bounds),
    "k04_item_view": _on_warehouse(lambda wh: _shown_view(filters.item_view(wh))),
    "k04f_item_view_filtered": _on_warehouse(lambda wh: _shown_view(filters.item_view(wh, BY_ITEM))),
    "k05_kept_orders": _on_warehouse(filters.kept_orders, filters=BY_ITEM),
    "k06_range_presets": _on_warehouse(_range_presets),
    "k07_relabel": _on_warehouse(_relabelled_statuses),
}


def _shown_view(view: DataFrame) -> DataFrame:
    money = {"price", "freight_value", "total_item_value"}
    return view.select(
        *[
            _as_double(F.col(c)).alias(c)
            if c in money
            else _two_places(F.col(c)).alias(c)
            if c == "buyer_seller_distance_km"
            else F.col(c)
            for c in view.columns
        ]
    )


_DASHBOARD = {
    "d01_top_category_by_month": dashboard.top_category_by_month,
    "d02_top_month_by_year": dashboard.top_month_by_year,
    "d03_yearly_revenue_top8": dashboard.yearly_revenue_of_top_categories,
    "d04_cancelled_by_category": dashboard.cancelled_by_category,
    "d05_delivery_vs_review": dashboard.delivery_vs_review,
    "d06_price_vs_freight": dashboard.price_vs_freight,
    "d07_size_vs_freight": dashboard.size_vs_freight,
    "d08_weight_vs_freight": dashboard.weight_vs_freight,
    "d09_freight_pct_vs_review": dashboard.freight_share_vs_review,
    "d10w_winner_by_month": dashboard.winning_method_by_month,
    "d10s_quarter_mix": dashboard.method_mix_by_quarter,
    "d10a_quarter_axis": dashboard.quarter_axis,
    "d11_photos_vs_orders": dashboard.photos_vs_orders,
    "d12_orders_by_hour": dashboard.orders_by_hour,
    "d12p_peak_hour": dashboard.peak_hour,
    "d13_top_units_by_month": dashboard.top_units_by_month,
    "d14_late_rate_by_size": dashboard.late_rate_by_size,
    "d15_instalments_by_category": dashboard.instalments_by_category,
}
for _name, _plan in _DASHBOARD.items():
    QUERIES[_name] = _on_warehouse(_plan, filters=BY_ITEM)
for _name in ("d01_top_category_by_month", "d03_yearly_revenue_top8", "d10w_winner_by_month"):
    _head, _rest = _name.split("_", 1)
    QUERIES[f"{_head}o_{_rest}"] = _on_warehouse(_DASHBOARD[_name], filters=BY_ORDER)

QUERIES |= {
    # further analytics
    "p01_monthly_revenue": _on_warehouse(sales.monthly_revenue),
    "p02_top_categories": _on_warehouse(sales.top_categories),
    "p03_revenue_by_region": _on_warehouse(sales.revenue_by_region),
    "p04_avg_price_by_category": _on_warehouse(sales.average_price_by_category),
    "p05_repeat_customers": _on_warehouse(people.repeat_customers, repeat_from=REPEAT_FROM),
    "p05t_repeat_customers_from_two": _on_warehouse(people.repeat_customers, repeat_from=2),
    "p05u_unattributed_revenue": _on_warehouse(people.unattributed_revenue),
    "p06_rfm_segments": _with_work(people.rfm_segments, "p06"),
    "p07_delivery_kpis": _on_warehouse(shipping.delivery_kpis),
    "p08_processing_by_seller_state": _on_warehouse(shipping.processing_by_seller_state),
    "p09_late_rate_by_region": _on_warehouse(shipping.late_rate_by_region),
    "p10_lateness_vs_review": _on_warehouse(shipping.lateness_vs_review),
    "p11_payment_method_summary": _on_warehouse(ordering.payment_method_summary),
    "p12_instalment_bands": _on_warehouse(ordering.instalment_bands),
    "p13_basket_vs_paid": _on_warehouse(ordering.basket_vs_paid),
    "p14_score_distribution": _on_warehouse(people.score_distribution),
    "p15_review_by_category": _on_warehouse(people.review_by_category, min_orders=10),
    "p15t_review_by_category_of_fifty": _on_warehouse(people.review_by_category, min_orders=50),
    "p16_distance_vs_review": _on_warehouse(shipping.distance_vs_review),
    "p17_freight_pct_by_category": _on_warehouse(shipping.freight_share_by_category),
    "p18_seller_pareto": _with_work(people.seller_pareto, "p18"),
    "p18r_seller_running_share": _with_work(people.seller_running_share, "p18r"),
    "p19_category_pairs": _on_warehouse(ordering.category_pairs),
    "p19o_category_pairs_in_orders": _on_warehouse(ordering.category_pairs, count="orders"),
    "p20_split_payment_rate": _on_warehouse(ordering.split_payment_rate),
    "p21_avg_transaction_value": _on_warehouse(ordering.average_transaction_value),
    "p22_comment_rate": _on_warehouse(people.comment_rate),
    "p23_avg_review_score": _on_warehouse(people.average_review_score),
    "p24_item_ratios": _on_warehouse(shipping.overall_item_ratios),
    # data quality: the checks, then the same operators where there is something to find
    "l01_unique": _on_warehouse(quality.unique_violations),
    "l02_not_null": _on_warehouse(quality.null_violations),
    "l03_relationships": _on_warehouse(quality.relationship_violations),
    "l04_accepted_values": _on_warehouse(quality.accepted_violations),
    "l05_grain": _on_warehouse(quality.grain_violations),
    "l06_lost_rows": _on_warehouse(quality.lost_rows),
    "l06a_accounts": _on_warehouse(quality.accounts),
    "l06c_row_counts": _on_warehouse(quality.row_counts),
    "l07_revenue_mismatch": _on_warehouse(
        lambda wh: _as_doubles(quality.revenue_mismatch(wh))
    ),
    "l07t_revenue_totals": _on_warehouse(lambda wh: _as_doubles(quality.revenue_totals(wh))),
    "l08_report": _on_warehouse(quality.report),
    "l09_negative_durations": _on_warehouse(quality.negative_durations),
    "l09n_early_deliveries": _on_warehouse(
        quality.negative_durations, columns=["delivery_days", "delivery_delay_days"]
    ),
    "l01d_duplicate_lines": _on_given(_report_on_duplicates),
    "l02n_null_counts": _on_warehouse(_null_payment_parts),
    "l04o_outside_values": _on_given(_outside_values),
}


def _as_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[_as_double(F.col(c)).alias(c) for c in df.columns])
