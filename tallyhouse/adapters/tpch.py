"""TPC-H-like tables in the shape of the nine raw marketplace tables.

Those tables have no payments, reviews, coordinates or delivery dates; they are
derived by fixed arithmetic on the given columns, row by row. Nothing here
shuffles, so the adapter stays a projection of the scan at any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.session import shared_folder

FIRST_DAY = date(1995, 1, 1)
LAST_DAY = date(2024, 12, 31)

# Nation number to state; the last nation gets a code of no region.
NATION_STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT",
    "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RS", "SC", "SP", "ZZ",
]
STATUS_OF = {"F": "delivered", "O": "shipped"}
METHOD_OF = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "voucher",
    "4-NOT SPECIFIED": "not_defined",
}


def _money(value: Column) -> Column:
    return value.cast(schemas.MONEY)


def _scaled(value: Column, factor: str) -> Column:
    """Money times a decimal constant, rounded to cents."""
    return (_money(value) * F.lit(factor).cast("decimal(9,4)")).cast(schemas.MONEY)


def _plus(moment: Column, days: Column | None = None, hours: Column | None = None) -> Column:
    zero = F.lit(0)
    return moment + F.make_dt_interval(zero if days is None else days, zero if hours is None else hours)


def _zip(nation: Column, number: Column) -> Column:
    return F.lpad((nation * 100 + number % 20).cast("string"), 5, "0")


def _state(nation: Column) -> Column:
    names = F.array(*[F.lit(s) for s in NATION_STATES])
    return F.element_at(names, (nation + 1).cast("int"))


def customers(t: Callable[[str], DataFrame]) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return t("customer").select(
        key.cast("string").alias("customer_id"),
        F.floor(key / 2).cast("bigint").cast("string").alias("customer_unique_id"),
        _zip(nation, key).alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("customer_city"),
        F.lower(_state(nation)).alias("customer_state"),
    )


def orders(t: Callable[[str], DataFrame]) -> DataFrame:
    key, customer, letter = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    day = F.col("o_orderdate")
    approved = _plus(day, (key % 3).cast("int"))
    carrier = _plus(day, (key % 3 + key % 7 + 1).cast("int"))
    delivered = _plus(day, (key % 3 + key % 7 + 1 + customer % 25).cast("int"), F.lit(12))
    status = F.when(letter.isin(list(STATUS_OF)), F.element_at(
        F.create_map(*[F.lit(x) for pair in STATUS_OF.items() for x in pair]), letter
    )).otherwise(F.when(key % 5 == 0, "unavailable").otherwise("canceled"))
    return t("orders").select(
        key.alias("order_id"),
        customer.cast("string").alias("customer_id"),
        status.alias("order_status"),
        _plus(day, hours=((key * 7 + customer) % 24).cast("int")).alias("order_purchase_timestamp"),
        approved.alias("order_approved_at"),
        carrier.alias("order_delivered_carrier_date"),
        F.when(letter != "P", delivered).alias("order_delivered_customer_date"),
        _plus(day, F.lit(21)).alias("order_estimated_delivery_date"),
    )


def order_items(t: Callable[[str], DataFrame]) -> DataFrame:
    """Lines get an id made of all their columns.

    ``l_linenumber`` repeats within an order. Numbering the lines would need
    every order's lines in one task; an id that is a function of the row needs
    no shuffle, differs for different rows, and is equal only for full copies.
    """
    numbers = ["l_linenumber", "l_partkey", "l_suppkey"]
    hundredths = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    line_id = F.concat_ws(
        "|",
        *[F.col(c).cast("string") for c in numbers],
        *[F.floor(F.col(c) * 100 + 0.5).cast("string") for c in hundredths],
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        F.unix_date(F.col("l_shipdate").cast("date")).cast("string"),
    )
    price = _scaled(F.col("l_extendedprice"), "0.005")
    return t("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        line_id.alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(6,2)") * 5).cast(schemas.MONEY).alias(
            "freight_value"
        ),
    )


def order_payments(t: Callable[[str], DataFrame]) -> DataFrame:
    """One payment per order, and a voucher as a second one on every seventh."""
    key, word = F.col("o_orderkey"), F.col("o_orderpriority")
    parts = F.when(key % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    method = F.lit("debit_card")
    for given, name in METHOD_OF.items():
        method = F.when(word == given, name).otherwise(method)
    total = F.col("o_totalprice")
    sequence = F.col("payment_sequential")
    return (
        t("orders")
        .select("o_orderkey", "o_orderpriority", "o_totalprice", F.explode(parts).alias("payment_sequential"))
        .select(
            key.alias("order_id"),
            "payment_sequential",
            F.when(sequence == 2, "voucher").otherwise(method).alias("payment_type"),
            (key % 16).cast("int").alias("payment_installments"),
            F.when(sequence == 2, _scaled(total, "0.001"))
            .otherwise(_scaled(total, "0.005"))
            .alias("payment_value"),
        )
    )


def order_reviews(t: Callable[[str], DataFrame]) -> DataFrame:
    """One review per event; every tenth falls on the order before its own."""
    event, at = F.col("event_id"), F.col("ts")
    return t("events").select(
        event.cast("string").alias("review_id"),
        F.when(event % 10 == 9, event - 1).otherwise(event).alias("order_id"),
        (F.floor(F.col("value")).cast("int") % 5 + 1).alias("review_score"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("review_comment_message"),
        at.cast("date").cast("timestamp_ntz").alias("review_creation_date"),
        at.alias("review_answer_timestamp"),
    )


def _category(kind: Column, size: Column) -> Column:
    return F.concat(F.lower(kind), F.lit("_"), (size % 5).cast("string"))


def products(t: Callable[[str], DataFrame]) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return t("part").select(
        key.cast("string").alias("product_id"),
        F.when(key % 50 != 0, _category(F.col("p_type"), size)).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (F.length("p_name") * 10).alias("product_description_lenght"),
        F.when(key % 37 != 0, size % 9).alias("product_photos_qty"),
        F.when(key % 33 != 0, size * 250).alias("product_weight_g"),
        F.when(key % 40 != 0, size + 5).alias("product_length_cm"),
        (key % 30 + 10).cast("int").alias("product_height_cm"),
        (key % 20 + 5).cast("int").alias("product_width_cm"),
    )


def category_translation(t: Callable[[str], DataFrame]) -> DataFrame:
    """English names for four of every five categories."""
    return (
        t("part")
        .filter(F.col("p_size") % 5 != 4)
        .select(_category(F.col("p_type"), F.col("p_size")).alias("product_category_name"))
        .distinct()
        .withColumn(
            "product_category_name_english", F.concat(F.lit("en_"), F.col("product_category_name"))
        )
    )


def sellers(t: Callable[[str], DataFrame]) -> DataFrame:
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return t("supplier").select(
        key.cast("string").alias("seller_id"),
        _zip(nation, key).alias("seller_zip_code_prefix"),
        F.concat(F.lit("City "), nation.cast("string")).alias("seller_city"),
        _state(nation).alias("seller_state"),
    )


def geolocation(t: Callable[[str], DataFrame]) -> DataFrame:
    """One point per customer; coordinates are binary fractions (exact sums)."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    home = F.when(key % 11 == 0, (nation + 1) % 25).otherwise(nation)
    return t("customer").select(
        _zip(nation, key).alias("geolocation_zip_code_prefix"),
        (F.lit(-30.0) + nation * F.lit(1.5) + (key % 8) * F.lit(0.125)).alias("geolocation_lat"),
        (F.lit(-70.0) + nation * F.lit(1.25) + (key % 16) * F.lit(0.0625)).alias("geolocation_lng"),
        F.when(key % 2 == 0, F.concat(F.lit(" "), F.col("c_mktsegment"))).otherwise(
            F.lower(F.col("c_mktsegment"))
        ).alias("geolocation_city"),
        F.lower(_state(home)).alias("geolocation_state"),
    )


TABLES = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "category_translation": category_translation,
}


_GIVEN: dict[tuple[str, str, str], DataFrame] = {}


def given_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its footer is read once per application."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _GIVEN:
        _GIVEN[key] = spark.read.parquet(f"{folder}/{name}.parquet")
    return _GIVEN[key]


def sources(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    def table(name: str) -> DataFrame:
        return given_table(spark, folder, name)

    return {name: (lambda derive=derive: derive(table)) for name, derive in TABLES.items()}


_OPEN: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over a folder of given tables, one per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        name = hashlib.sha256(folder.encode()).hexdigest()[:12]
        place = f"{shared_folder(spark)}/tallyhouse/{key[0]}/{name}"
        _OPEN[key] = Warehouse(spark, sources(spark, folder), place, FIRST_DAY, LAST_DAY)
    return _OPEN[key]
