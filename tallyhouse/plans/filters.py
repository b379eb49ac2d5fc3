"""One filter object that narrows every question, at item or at order level."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.operators.rows import dedup
from tallyhouse.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Filters:
    """None means "not narrowed"; an empty tuple means "nothing matches"."""

    start: date | None = None
    end: date | None = None
    regions: tuple[str, ...] | None = None
    customer_states: tuple[str, ...] | None = None
    categories: tuple[str, ...] | None = None
    payment_labels: tuple[str, ...] | None = None


def one_of(df: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Keep rows whose column is one of ``values`` (None: all rows, []: none)."""
    if values is None:
        return df
    return df.filter(F.col(column).isin(list(values)) if values else F.lit(False))


def picked(chosen: Sequence, options: Sequence) -> tuple | None:
    """What a multi-select means: everything chosen is no narrowing at all."""
    return None if set(chosen) == set(options) else tuple(chosen)


def resolve_range(
    preset: str | int, first: date, last: date, custom: tuple[date, date] | None = None
) -> tuple[date, date]:
    """The days of a preset: ``"all"``, a year, or ``"custom"`` with two days."""
    if preset == "all":
        start, end = first, last
    elif preset == "custom":
        if custom is None:
            raise ValueError("custom needs two days")
        start, end = custom
    else:
        year = int(preset)
        start, end = max(first, date(year, 1, 1)), min(last, date(year, 12, 31))
    return (end, start) if start > end else (start, end)


def _day_number(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _in_days(df: DataFrame, filters: Filters) -> DataFrame:
    """Date range on the fact's own key, so that it reaches the scan.

    The key is ``yyyymmdd``: a range of days is a range of keys, and of the
    years that are the partitions. Rows with the Unknown day (-1) have no date
    and never pass once a bound is set.
    """
    if filters.start is None and filters.end is None:
        return df
    key, year = F.col("purchase_date_key"), F.col("purchase_year")
    out = df.filter(key != fixed.UNKNOWN_KEY)
    if filters.start is not None:
        out = out.filter((key >= _day_number(filters.start)) & (year >= filters.start.year))
    if filters.end is not None:
        out = out.filter((key <= _day_number(filters.end)) & (year <= filters.end.year))
    return out


# Attribute of the item view -> (dimension, fact key, dimension key, column)
_ATTRIBUTES = {
    "purchase_date": ("dim_date", "purchase_date_key", "date_key", "full_date"),
    "purchase_year": ("dim_date", "purchase_date_key", "date_key", "year"),
    "purchase_year_month": ("dim_date", "purchase_date_key", "date_key", "year_month"),
    "product_category": ("dim_products", "product_key", "product_key", "category"),
    "product_size_band": ("dim_products", "product_key", "product_key", "size_band"),
    "customer_unique_id": ("dim_customers", "customer_key", "customer_key", "customer_unique_id"),
    "customer_state": ("dim_customers", "customer_key", "customer_key", "state"),
    "customer_region": ("dim_geography", "customer_geography_key", "geography_key", "region"),
    "order_status": ("dim_order_status", "order_status_key", "order_status_key", "status_label"),
    "status_step": ("dim_order_status", "order_status_key", "order_status_key", "lifecycle_step"),
}
_MEASURES = [
    "order_id",
    "price",
    "freight_value",
    "total_item_value",
    "delivery_days",
    "seller_processing_days",
    "carrier_transit_days",
    "delivery_delay_days",
    "buyer_seller_distance_km",
    "is_late_delivery",
    "purchase_hour",
]
ITEM_VIEW_COLUMNS = [*_MEASURES, *_ATTRIBUTES]


def star(
    wh: Warehouse, fact: DataFrame, roles: dict[str, tuple[str, str, dict[str, str]]]
) -> DataFrame:
    """Join dimensions to a fact on their surrogate keys.

    ``roles`` maps a fact key to (dimension, dimension key, {column: name}).
    Sizes of the written dimensions are known, so small ones are broadcast and
    large ones are joined by a shuffle that AQE may split.
    """
    out = fact
    for fact_key, (dimension, key, columns) in roles.items():
        side = wh[dimension].select(
            F.col(key).alias(f"_{fact_key}"),
            *[F.col(c).alias(name) for c, name in columns.items()],
        )
        out = out.join(side, F.col(fact_key) == F.col(f"_{fact_key}")).drop(f"_{fact_key}")
    return out


def _attributes(wh: Warehouse, fact: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add attributes to a fact, joining only the dimensions they live in.

    Each fact key resolves to exactly one member (Unknown included), so a
    dimension of which nothing is needed can be left out without changing the
    rows.
    """
    roles: dict[str, tuple[str, str, dict[str, str]]] = {}
    for name in names:
        dimension, fact_key, key, column = _ATTRIBUTES[name]
        roles.setdefault(fact_key, (dimension, key, {}))[2][column] = f"_at_{name}"
    joined = star(wh, fact, roles)
    return joined.withColumns({name: F.col(f"_at_{name}") for name in names})


def item_view(wh: Warehouse, filters: Filters = Filters(), columns: Sequence[str] | None = None) -> DataFrame:
    """Items with the attributes of their date, product, customer and status.

    The filters apply to the items themselves. With ``columns`` only those are
    returned, and only the dimensions needed for them and for the filters are
    joined.
    """
    wanted = list(ITEM_VIEW_COLUMNS if columns is None else columns)
    narrowing = {
        "customer_region": filters.regions,
        "customer_state": filters.customer_states,
        "product_category": filters.categories,
    }
    tested = [name for name, values in narrowing.items() if values is not None]
    needed = [name for name in _ATTRIBUTES if name in wanted or name in tested]
    out = _attributes(wh, _in_days(wh["fact_order_items"], filters), needed)
    for name in tested:
        out = one_of(out, name, narrowing[name])
    return out.select(*wanted)


def kept_orders(wh: Warehouse, filters: Filters) -> DataFrame:
    """Ids of the orders with at least one item that passes the filters.

    A dashboard asks a dozen questions of one set of filters. The ids are found once per
    set and build and written, so the questions after the first do not read the items
    for them, and Spark knows their true size.
    """
    return wh.remembered(("kept orders", filters), lambda: item_view(wh, filters, ["order_id"]).distinct())


def _order_scope(
    wh: Warehouse, fact: str, filters: Filters | None
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of a fact, and the orders they still have to belong to.

    Day, region and state are the same for all items of an order, so without a
    category filter an item is in a kept order exactly when it passes itself,
    and no semi-join is left to do. The other facts may hold orders without
    items and always need it.
    """
    rows = wh[fact]
    if filters is None:
        return rows, None
    # The purchase day comes from the same order header in every fact, so
    # narrowing by it changes nothing but the rows scanned.
    dated = _in_days(rows, filters)
    if fact != "fact_order_items" or filters.categories is not None:
        return dated, kept_orders(wh, filters)
    tested = {"customer_region": filters.regions, "customer_state": filters.customer_states}
    names = [name for name, values in tested.items() if values is not None]
    passing = _attributes(wh, dated, names) if names else dated
    for name in names:
        passing = one_of(passing, name, tested[name])
    return passing.select(*rows.columns), None


def within_orders(wh: Warehouse, fact: str, filters: Filters | None) -> DataFrame:
    """The fact's rows that belong to kept orders (order-level filtering).

    Other items of a kept order stay. Use ``per_order`` instead where the rows
    are then grouped by order.
    """
    rows, kept = _order_scope(wh, fact, filters)
    if kept is None:
        return rows
    return rows.join(kept, "order_id", "left_semi").select(*rows.columns)


def per_order(
    wh: Warehouse,
    fact: str,
    filters: Filters | None,
    aggregates: Sequence[Column],
    groups: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    meets_kept: bool = False,
) -> DataFrame:
    """A fact at the grain of kept orders (and ``groups`` within them).

    Rows are aggregated before the semi-join. In the other order the join would
    shuffle raw rows by order, and the grouping after it would keep Spark from
    splitting an order that holds very many of them. ``meets_kept`` says that
    the result will be inner-joined with kept orders anyway, which saves the
    semi-join on this side.
    """
    rows, kept = _order_scope(wh, fact, filters)
    ready = prepare(rows) if prepare else rows
    grouped = ready.groupBy("order_id", *groups).agg(*aggregates)
    if kept is None or meets_kept:
        return grouped
    return grouped.join(kept, "order_id", "left_semi")


def within_payments(wh: Warehouse, filters: Filters | None) -> DataFrame:
    """Payments of kept orders by valid methods, with the method's label."""
    rows = star(
        wh,
        within_orders(wh, "fact_order_payments", filters),
        {
            "payment_type_key": (
                "dim_payment_type",
                "payment_type_key",
                {"payment_label": "payment_label", "is_valid_method": "is_valid_method"},
            )
        },
    ).filter("is_valid_method")
    return one_of(rows, "payment_label", filters.payment_labels if filters else None)


def filter_options(wh: Warehouse) -> DataFrame:
    """What each filter can be set to; Unknown members are not offered."""

    def options(kind: str, dimension: str, column: str, condition: Column) -> DataFrame:
        return (
            wh[dimension]
            .filter(condition)
            .select(F.lit(kind).alias("filter"), F.col(column).alias("option"))
            .distinct()
        )

    return (
        options("regions", "dim_geography", "region", F.col("region") != "Unknown")
        .unionByName(options("customer_states", "dim_customers", "state", F.col("state") != "XX"))
        .unionByName(options("categories", "dim_products", "category", F.col("category") != "unknown"))
        .unionByName(
            options("payment_labels", "dim_payment_type", "payment_label", F.col("is_valid_method"))
        )
        .orderBy("filter", "option")
    )


def date_bounds(wh: Warehouse) -> DataFrame:
    """First and last purchase day; rows without a day do not count.

    Order of keys is order of days, so the bounds are found on the fact alone
    and only two keys are looked up in the calendar. Rows without a day have a
    partition of their own, so the bounds of the others are in the file footers.
    """
    keys = (
        wh.footers("fact_order_items")
        .filter(F.col("purchase_year") != fixed.UNKNOWN_KEY)
        .agg(F.min("purchase_date_key").alias("lo"), F.max("purchase_date_key").alias("hi"))
    )
    days = wh["dim_date"].select("date_key", F.col("full_date"))
    return (
        keys.join(days.withColumnRenamed("full_date", "first_day"), F.col("lo") == F.col("date_key"), "left")
        .drop("date_key")
        .join(days.withColumnRenamed("full_date", "last_day"), F.col("hi") == F.col("date_key"), "left")
        .select("first_day", "last_day")
    )


def relabel(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """Replace codes by the labels of a (code, label) table.

    A code without a label is shown with spaces for underscores; NULL becomes
    the text of a missing value. The label table is the caller's.
    """
    looked_up = dedup(
        labels.select(
            F.col(labels.columns[0]).alias("_code"), F.col(labels.columns[1]).alias("_label")
        ),
        ["_code"],
    )
    shown = F.coalesce(
        F.col("_label"), F.replace(F.col(column).cast("string"), F.lit("_"), F.lit(" ")), F.lit("None")
    )
    joined = df.join(looked_up, F.col(column) == F.col("_code"), "left")
    return joined.select(*[(shown if c == column else F.col(c)).alias(c) for c in df.columns])
