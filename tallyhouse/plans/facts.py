"""The order header and the three facts built on it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse import schemas
from tallyhouse.functions import scalars as S
from tallyhouse.operators.rows import dedup_few, resolve_fk, unknown_if_missing
from tallyhouse.sources.tables import TableFolder

UNKNOWN = fixed.UNKNOWN_KEY


def loaded_at() -> Column:
    """When a fact row was written (wall clock; never compared)."""
    return F.localtimestamp()


def order_header(
    orders: DataFrame,
    customers: DataFrame,
    geography: DataFrame,
    statuses: DataFrame,
    first: date,
    last: date,
    work: TableFolder,
) -> DataFrame:
    """One row per order with everything the facts take from the order.

    All facts need the same customer, place, status and dates. Resolving them
    once per order, not once per item, payment and review, keeps the large
    customer join at the smallest grain.
    """
    header = dedup_few(orders.drop("ingestion_timestamp"), ["order_id"], work)
    header = resolve_fk(
        header,
        customers,
        on={"customer_id": "customer_id"},
        take={"customer_key": UNKNOWN, "geography_key": UNKNOWN},
    )
    header = resolve_fk(
        header,
        geography,
        on={"geography_key": "geography_key"},
        take={"latitude": None, "longitude": None},
    )
    header = resolve_fk(
        header, statuses, on={"order_status": "order_status"}, take={"order_status_key": UNKNOWN}
    )
    purchased = F.col("order_purchase_timestamp")
    approved = F.col("order_approved_at")
    carrier = F.col("order_delivered_carrier_date")
    delivered = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    roles = {
        "purchase": purchased,
        "approved": approved,
        "carrier": carrier,
        "delivered": delivered,
        "estimated": promised,
    }
    return header.select(
        "order_id",
        *[S.date_key(at, first, last).alias(f"{role}_date_key") for role, at in roles.items()],
        "customer_key",
        F.col("geography_key").alias("customer_geography_key"),
        "order_status_key",
        F.col("latitude").alias("customer_latitude"),
        F.col("longitude").alias("customer_longitude"),
        S.days_between(purchased, delivered).alias("delivery_days"),
        S.days_between(approved, carrier).alias("seller_processing_days"),
        S.days_between(carrier, delivered).alias("carrier_transit_days"),
        S.days_between(promised, delivered).alias("delivery_delay_days"),
        S.late_flag(delivered, promised).alias("is_late_delivery"),
        F.hour(purchased).alias("purchase_hour"),
    )


def _with_header(child: DataFrame, header: DataFrame, columns: list[str]) -> DataFrame:
    """Left join the order header; orders that do not exist give Unknown keys."""
    taken = header.select("order_id", *columns)
    joined = child.join(taken, "order_id", "left")
    keys = {c: unknown_if_missing(c) for c in columns if c.endswith("_key")}
    return joined.withColumns(keys)


def _purchase_year() -> Column:
    """Partition column of the facts; -1 collects rows without a date."""
    key = F.col("purchase_date_key")
    return F.when(key == UNKNOWN, UNKNOWN).otherwise(F.floor(key / 10000)).cast("int")


DATE_ROLES = ["purchase", "approved", "carrier", "delivered", "estimated"]
DURATIONS = [
    "delivery_days",
    "seller_processing_days",
    "carrier_transit_days",
    "delivery_delay_days",
]


def fact_order_items(
    items: DataFrame,
    header: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    geography: DataFrame,
    work: TableFolder,
) -> DataFrame:
    """One row per order line.

    Copies are removed before the joins, by the whole grain, so an order with very many
    lines is spread. Lines are shuffled by product, where products are many, and last by
    order, which is also how they are written; AQE splits an order with very many lines.
    """
    lines = dedup_few(
        items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
        ["order_id", "order_item_id"],
        work,
    )
    lines = resolve_fk(
        lines, products, on={"product_id": "product_id"}, take={"product_key": UNKNOWN}
    )
    lines = resolve_fk(
        lines,
        sellers,
        on={"seller_id": "seller_id"},
        take={"seller_key": UNKNOWN, "geography_key": UNKNOWN},
    )
    lines = resolve_fk(
        lines,
        geography,
        on={"geography_key": "geography_key"},
        take={"latitude": None, "longitude": None},
    )
    lines = _with_header(
        lines,
        header,
        [
            *[f"{role}_date_key" for role in DATE_ROLES],
            "customer_key",
            "order_status_key",
            "customer_geography_key",
            "customer_latitude",
            "customer_longitude",
            *DURATIONS,
            "is_late_delivery",
            "purchase_hour",
        ],
    )
    distance = S.great_circle_km(
        F.col("customer_latitude"),
        F.col("customer_longitude"),
        F.col("latitude"),
        F.col("longitude"),
    )
    return lines.select(
        "order_id",
        "order_item_id",
        *[f"{role}_date_key" for role in DATE_ROLES],
        "product_key",
        "customer_key",
        "seller_key",
        "order_status_key",
        "customer_geography_key",
        F.col("geography_key").alias("seller_geography_key"),
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).cast(schemas.MONEY).alias("total_item_value"),
        *DURATIONS,
        distance.alias("buyer_seller_distance_km"),
        "is_late_delivery",
        "purchase_hour",
        loaded_at().alias("insertion_timestamp"),
        _purchase_year().alias("purchase_year"),
    )


def fact_order_payments(
    payments: DataFrame, header: DataFrame, methods: DataFrame, work: TableFolder
) -> DataFrame:
    """One row per payment transaction of an order."""
    paid = dedup_few(payments.drop("ingestion_timestamp"), ["order_id", "payment_sequential"], work)
    paid = resolve_fk(
        paid, methods, on={"payment_type": "payment_type"}, take={"payment_type_key": UNKNOWN}
    )
    paid = _with_header(
        paid,
        header,
        ["purchase_date_key", "customer_key", "customer_geography_key", "order_status_key"],
    )
    parts = F.col("payment_installments")
    per_part = F.when(parts > 0, F.round(F.col("payment_value") / parts, 2)).cast(schemas.MONEY)
    return paid.select(
        "order_id",
        "payment_sequential",
        "purchase_date_key",
        "customer_key",
        "customer_geography_key",
        "payment_type_key",
        "order_status_key",
        "payment_value",
        "payment_installments",
        per_part.alias("instalment_amount"),
        (F.col("payment_sequential") > 1).alias("is_split_payment"),
        (parts > 1).alias("is_instalment_plan"),
        loaded_at().alias("insertion_timestamp"),
        _purchase_year().alias("purchase_year"),
    )


def fact_order_reviews(
    reviews: DataFrame, header: DataFrame, first: date, last: date, work: TableFolder
) -> DataFrame:
    """One row per review and order; neither column is unique alone."""
    given = dedup_few(
        reviews.select(
            "review_id",
            "order_id",
            "review_score",
            "review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
        ),
        ["review_id", "order_id"],
        work,
    )
    given = _with_header(
        given,
        header,
        ["purchase_date_key", "customer_key", "customer_geography_key", "order_status_key"],
    )
    created, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")
    comment, score = F.col("review_comment_message"), F.col("review_score")
    return given.select(
        "review_id",
        "order_id",
        "purchase_date_key",
        S.date_key(created, first, last).alias("review_created_date_key"),
        S.date_key(answered, first, last).alias("review_answered_date_key"),
        "customer_key",
        "customer_geography_key",
        "order_status_key",
        "review_score",
        S.hour_boundaries(created, answered).alias("response_hours"),
        S.flag(comment.isNotNull()).alias("has_comment"),
        F.coalesce(F.length(comment), F.lit(0)).alias("comment_length"),
        S.flag(score >= fixed.POSITIVE_FROM).alias("is_positive"),
        S.flag(score <= fixed.NEGATIVE_TO).alias("is_negative"),
        loaded_at().alias("insertion_timestamp"),
        _purchase_year().alias("purchase_year"),
    )
