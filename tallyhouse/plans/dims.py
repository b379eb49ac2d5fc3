"""The seven conformed dimensions, each with its Unknown member."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import scalars as S
from tallyhouse.operators.ranking import dense_key, most_frequent
from tallyhouse.operators.rows import dedup, resolve_fk, with_unknown
from tallyhouse.sources.tables import TableFolder


def calendar_days(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    span = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(0, 1, 1, 1).select(F.explode(span).alias("day"))


def dim_date(spark: SparkSession, first: date, last: date) -> DataFrame:
    day = F.col("day")
    sunday_first = F.dayofweek(day) - 1
    out = calendar_days(spark, first, last).select(
        S.yyyymmdd(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")).alias(
            "year_quarter"
        ),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.dayofmonth(day).alias("day_of_month"),
        sunday_first.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        sunday_first.isin(0, 6).alias("is_weekend"),
        F.weekofyear(day).alias("week_of_year"),
    )
    unknown = {
        "date_key": fixed.UNKNOWN_KEY,
        "year_quarter": "Unknown",
        "month_name": "Unknown",
        "year_month": "Unknown",
        "day_name": "Unknown",
    }
    return with_unknown(out, unknown)


def points_per_zip(geolocation: DataFrame) -> DataFrame:
    """One row per zip: mean point, most frequent city and state.

    Names are counted per zip before the most frequent is chosen, so neither a zip with
    very many points nor the group of all zips that are not numbers (NULL) gathers its
    names in one task's memory. Ties between equally frequent names go to the smallest
    one; a zip that has no names stays.
    """
    points = geolocation.select(
        F.col("geolocation_zip_code_prefix").try_cast("int").alias("zip_code_prefix"),
        S.tidy_city(F.col("geolocation_city")).alias("city"),
        S.tidy_state(F.col("geolocation_state")).alias("state"),
        F.col("geolocation_lat").alias("latitude"),
        F.col("geolocation_lng").alias("longitude"),
    )
    out = points.groupBy("zip_code_prefix").agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")
    )
    for name in ("city", "state"):
        usual = most_frequent(points, ["zip_code_prefix"], name, name).withColumnRenamed("zip_code_prefix", "_zip")
        out = out.join(usual, F.col("zip_code_prefix").eqNullSafe(F.col("_zip")), "left").drop("_zip")
    return out.select("zip_code_prefix", "city", "state", "latitude", "longitude")


def dim_geography(geolocation: DataFrame, slices: TableFolder) -> DataFrame:
    zips = points_per_zip(geolocation).select(
        "zip_code_prefix",
        "city",
        "state",
        S.region_of_state(F.col("state")).alias("region"),
        "latitude",
        "longitude",
    )
    keyed = dense_key(zips, "zip_code_prefix", "geography_key", slices, "dim_geography")
    return with_unknown(
        keyed,
        {
            "geography_key": fixed.UNKNOWN_KEY,
            "zip_code_prefix": -1,
            "city": "unknown",
            "state": "XX",
            "region": "Unknown",
        },
    )


def _located(df: DataFrame, geography: DataFrame) -> DataFrame:
    return resolve_fk(
        df,
        geography,
        on={"zip_code_prefix": "zip_code_prefix"},
        take={"geography_key": fixed.UNKNOWN_KEY},
    )


def dim_customers(customers: DataFrame, geography: DataFrame, slices: TableFolder) -> DataFrame:
    cleaned = customers.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").try_cast("int").alias("zip_code_prefix"),
        S.tidy_city(F.col("customer_city")).alias("city"),
        S.tidy_state(F.col("customer_state")).alias("state"),
    )
    unique = _located(dedup(cleaned, ["customer_id"]), geography).select(
        "customer_id", "customer_unique_id", "zip_code_prefix", "geography_key", "city", "state"
    )
    keyed = dense_key(unique, "customer_id", "customer_key", slices, "dim_customers")
    return with_unknown(
        keyed,
        {
            "customer_key": fixed.UNKNOWN_KEY,
            "customer_id": "unknown",
            "customer_unique_id": "unknown",
            "geography_key": fixed.UNKNOWN_KEY,
            "city": "unknown",
            "state": "XX",
        },
    )


def dim_sellers(sellers: DataFrame, geography: DataFrame, slices: TableFolder) -> DataFrame:
    cleaned = sellers.select(
        "seller_id",
        F.col("seller_zip_code_prefix").try_cast("int").alias("zip_code_prefix"),
        S.tidy_city(F.col("seller_city")).alias("city"),
        S.tidy_state(F.col("seller_state")).alias("state"),
    )
    unique = _located(dedup(cleaned, ["seller_id"]), geography).select(
        "seller_id", "zip_code_prefix", "geography_key", "city", "state"
    )
    keyed = dense_key(unique, "seller_id", "seller_key", slices, "dim_sellers")
    return with_unknown(
        keyed,
        {
            "seller_key": fixed.UNKNOWN_KEY,
            "seller_id": "unknown",
            "geography_key": fixed.UNKNOWN_KEY,
            "city": "unknown",
            "state": "XX",
        },
    )


def dim_products(products: DataFrame, translation: DataFrame, slices: TableFolder) -> DataFrame:
    unique = dedup(products.drop("ingestion_timestamp"), ["product_id"])
    # A word translated twice must not double its products.
    words = dedup(
        translation.select("product_category_name", "product_category_name_english"),
        ["product_category_name"],
    )
    named = resolve_fk(
        unique,
        words,
        on={"product_category_name": "product_category_name"},
        take={"product_category_name_english": None},
    )
    source_name = F.col("product_category_name")
    sides = [F.col(f"product_{side}_cm").cast("bigint") for side in ("length", "height", "width")]
    described = named.select(
        "product_id",
        F.coalesce("product_category_name_english", source_name, F.lit("unknown")).alias("category"),
        F.coalesce(source_name, F.lit("unknown")).alias("category_pt"),
        F.col("product_photos_qty").alias("photos_qty"),
        F.col("product_name_lenght").alias("name_length"),
        F.col("product_description_lenght").alias("description_length"),
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
        (sides[0] * sides[1] * sides[2]).alias("volume_cm3"),
    )
    volume = F.col("volume_cm3")
    banded = described.withColumn(
        "size_band",
        F.when(volume.isNull(), "Unknown").otherwise(
            S.bucketize(volume, fixed.SIZE_CUTS_CM3, fixed.SIZE_BANDS)
        ),
    )
    keyed = dense_key(banded, "product_id", "product_key", slices, "dim_products")
    return with_unknown(
        keyed,
        {
            "product_key": fixed.UNKNOWN_KEY,
            "product_id": "unknown",
            "category": "unknown",
            "category_pt": "unknown",
            "size_band": "Unknown",
        },
    )


def dim_order_status(orders: DataFrame, slices: TableFolder) -> DataFrame:
    status = F.col("order_status")
    seen = orders.select("order_status").distinct()
    keyed = dense_key(seen, "order_status", "order_status_key", slices, "dim_order_status")
    out = keyed.select(
        "order_status_key",
        "order_status",
        S.label_map(status, fixed.STATUS_LABELS).alias("status_label"),
        (status == "delivered").alias("is_delivered"),
        status.isin("canceled", "unavailable").alias("is_cancelled"),
        S.label_map(status, fixed.STATUS_STEPS, F.lit(fixed.STATUS_LAST_STEP)).alias(
            "lifecycle_step"
        ),
    )
    return with_unknown(
        out,
        {
            "order_status_key": fixed.UNKNOWN_KEY,
            "order_status": "unknown",
            "status_label": "Unknown",
            "is_delivered": False,
            "is_cancelled": False,
            "lifecycle_step": fixed.STATUS_LAST_STEP,
        },
    )


def dim_payment_type(payments: DataFrame, slices: TableFolder) -> DataFrame:
    method = F.col("payment_type")
    seen = payments.select("payment_type").distinct()
    keyed = dense_key(seen, "payment_type", "payment_type_key", slices, "dim_payment_type")
    out = keyed.select(
        "payment_type_key",
        "payment_type",
        S.label_map(method, fixed.PAYMENT_LABELS, S.plain_words(method)).alias("payment_label"),
        (method == "credit_card").alias("supports_instalments"),
        (method != "not_defined").alias("is_valid_method"),
    )
    return with_unknown(
        out,
        {
            "payment_type_key": fixed.UNKNOWN_KEY,
            "payment_type": "unknown",
            "payment_label": "Unknown",
            "supports_instalments": False,
            "is_valid_method": False,
        },
    )
