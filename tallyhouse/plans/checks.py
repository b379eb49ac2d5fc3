"""What is declared about the tables, and the part of it that is counted while they are written."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed

# --- what is declared about the tables ---------------------------------------
UNIQUE = {
    "dim_date": ["date_key", "full_date"],
    "dim_geography": ["geography_key", "zip_code_prefix"],
    "dim_customers": ["customer_key", "customer_id"],
    "dim_sellers": ["seller_key", "seller_id"],
    "dim_products": ["product_key", "product_id"],
    "dim_order_status": ["order_status_key", "order_status"],
    "dim_payment_type": ["payment_type_key", "payment_type"],
}
PARENTS = {
    "dim_customers": {"geography_key": ("dim_geography", "geography_key")},
    "dim_sellers": {"geography_key": ("dim_geography", "geography_key")},
    "fact_order_items": {
        "purchase_date_key": ("dim_date", "date_key"),
        "approved_date_key": ("dim_date", "date_key"),
        "carrier_date_key": ("dim_date", "date_key"),
        "delivered_date_key": ("dim_date", "date_key"),
        "estimated_date_key": ("dim_date", "date_key"),
        "product_key": ("dim_products", "product_key"),
        "customer_key": ("dim_customers", "customer_key"),
        "seller_key": ("dim_sellers", "seller_key"),
        "order_status_key": ("dim_order_status", "order_status_key"),
        "customer_geography_key": ("dim_geography", "geography_key"),
        "seller_geography_key": ("dim_geography", "geography_key"),
    },
    "fact_order_payments": {
        "purchase_date_key": ("dim_date", "date_key"),
        "customer_key": ("dim_customers", "customer_key"),
        "customer_geography_key": ("dim_geography", "geography_key"),
        "payment_type_key": ("dim_payment_type", "payment_type_key"),
        "order_status_key": ("dim_order_status", "order_status_key"),
    },
    "fact_order_reviews": {
        "purchase_date_key": ("dim_date", "date_key"),
        "review_created_date_key": ("dim_date", "date_key"),
        "review_answered_date_key": ("dim_date", "date_key"),
        "customer_key": ("dim_customers", "customer_key"),
        "customer_geography_key": ("dim_geography", "geography_key"),
        "order_status_key": ("dim_order_status", "order_status_key"),
    },
}
_MEASURED = {
    "fact_order_items": ["price", "freight_value"],
    "fact_order_payments": ["payment_value"],
    "fact_order_reviews": ["review_score"],
}
NOT_NULL = {
    table: [
        *[c for c in UNIQUE.get(table, []) if c != "full_date"],
        *PARENTS.get(table, {}),
        *_MEASURED.get(table, []),
    ]
    for table in [*UNIQUE, *_MEASURED]
}
ACCEPTED = {
    ("dim_geography", "region"): fixed.REGIONS,
    ("dim_products", "size_band"): fixed.SIZE_BANDS_ACCEPTED,
    ("fact_order_reviews", "review_score"): fixed.REVIEW_SCORES,
}
GRAINS = {
    "fact_order_items": ["order_id", "order_item_id"],
    "fact_order_payments": ["order_id", "payment_sequential"],
    "fact_order_reviews": ["review_id", "order_id"],
}
DURATIONS = ["delivery_days", "seller_processing_days", "carrier_transit_days"]


def _conditions(table: str) -> dict[tuple[str, str], Column]:
    """(check, column) of a table -> what a violating row satisfies."""
    found = {("not_null", c): F.col(c).isNull() for c in NOT_NULL.get(table, [])}
    for (of, c), values in ACCEPTED.items():
        if of == table:
            found["accepted_values", c] = F.col(c).isNotNull() & ~F.col(c).isin(list(values))
    if table == "fact_order_items":
        found |= {("negative_duration", c): F.col(c) < 0 for c in DURATIONS}
        total = F.col("price") + F.col("freight_value")
        found["line_total", "total_item_value"] = ~F.col("total_item_value").eqNullSafe(total.cast("decimal(18,2)"))
    return found


def measures(table: str) -> list[Column]:
    """Aggregates that count the violations of a table in the job that writes it."""
    return [F.count_if(condition).alias(f"{check}.{column}") for (check, column), condition in _conditions(table).items()]


def violations(measured: Mapping[str, Mapping[str, int]]) -> Iterator[tuple[str, str, str, int]]:
    """(table, check, column, rows) of what was counted and is not zero."""
    for table, counts in measured.items():
        for name, rows in counts.items():
            if rows:
                check, column = name.split(".", 1)
                yield table, check, column, rows
