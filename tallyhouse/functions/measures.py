"""What may be done with each measure of the facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions import scalars

ADDITIVE = "additive"
SEMI_ADDITIVE = "semi-additive"
NON_ADDITIVE = "non-additive"

MEASURES = {
    "price": ADDITIVE,
    "freight_value": ADDITIVE,
    "total_item_value": ADDITIVE,
    "payment_value": ADDITIVE,
    "is_late_delivery": SEMI_ADDITIVE,
    "has_comment": SEMI_ADDITIVE,
    "is_positive": SEMI_ADDITIVE,
    "is_negative": SEMI_ADDITIVE,
    "delivery_days": NON_ADDITIVE,
    "seller_processing_days": NON_ADDITIVE,
    "carrier_transit_days": NON_ADDITIVE,
    "delivery_delay_days": NON_ADDITIVE,
    "buyer_seller_distance_km": NON_ADDITIVE,
    "payment_installments": NON_ADDITIVE,
    "instalment_amount": NON_ADDITIVE,
    "review_score": NON_ADDITIVE,
    "response_hours": NON_ADDITIVE,
    "comment_length": NON_ADDITIVE,
    "purchase_hour": NON_ADDITIVE,
}


def total(name: str) -> Column:
    """Sum of a measure; refused where a sum has no meaning, or the name is unknown."""
    if name not in MEASURES:
        raise ValueError(f"{name} is not a measure")
    if MEASURES[name] == NON_ADDITIVE:
        raise ValueError(f"{name} is {NON_ADDITIVE}: average it, do not sum it")
    return F.sum(F.col(name))


def average(name: str) -> Column:
    return scalars.mean(F.col(name))


def share(name: str) -> Column:
    """Percent of rows for which a 0/1 measure is 1."""
    if MEASURES.get(name) != SEMI_ADDITIVE:
        raise ValueError(f"{name} is not a flag")
    return scalars.percent(F.col(name))
