"""Explicit schemas of the nine raw tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
_KINDS = {
    "str": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "money": MONEY,
    "time": T.TimestampNTZType(),
}


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[k], True) for n, k in columns.items()])


RAW = {
    "customers": _table(
        customer_id="str",
        customer_unique_id="str",
        customer_zip_code_prefix="str",
        customer_city="str",
        customer_state="str",
    ),
    "orders": _table(
        order_id="str",
        customer_id="str",
        order_status="str",
        order_purchase_timestamp="time",
        order_approved_at="time",
        order_delivered_carrier_date="time",
        order_delivered_customer_date="time",
        order_estimated_delivery_date="time",
    ),
    "order_items": _table(
        order_id="str",
        order_item_id="int",
        product_id="str",
        seller_id="str",
        shipping_limit_date="time",
        price="money",
        freight_value="money",
    ),
    "order_payments": _table(
        order_id="str",
        payment_sequential="int",
        payment_type="str",
        payment_installments="int",
        payment_value="money",
    ),
    "order_reviews": _table(
        review_id="str",
        order_id="str",
        review_score="int",
        review_comment_title="str",
        review_comment_message="str",
        review_creation_date="time",
        review_answer_timestamp="time",
    ),
    "products": _table(
        product_id="str",
        product_category_name="str",
        product_name_lenght="int",
        product_description_lenght="int",
        product_photos_qty="int",
        product_weight_g="int",
        product_length_cm="int",
        product_height_cm="int",
        product_width_cm="int",
    ),
    "sellers": _table(
        seller_id="str",
        seller_zip_code_prefix="str",
        seller_city="str",
        seller_state="str",
    ),
    "geolocation": _table(
        geolocation_zip_code_prefix="str",
        geolocation_lat="double",
        geolocation_lng="double",
        geolocation_city="str",
        geolocation_state="str",
    ),
    "category_translation": _table(
        product_category_name="str",
        product_category_name_english="str",
    ),
}

DIMENSIONS = [
    "dim_date",
    "dim_geography",
    "dim_customers",
    "dim_sellers",
    "dim_products",
    "dim_order_status",
    "dim_payment_type",
]
FACTS = ["fact_order_items", "fact_order_payments", "fact_order_reviews"]
WAREHOUSE_TABLES = DIMENSIONS + FACTS
