from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.plans.dims import dim_date
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.session import shared_folder
from tallyhouse.sources import catalog
from tallyhouse.sources.staging import csv_sources, register_views, scan_csv
from tests.conftest import rows


def test_csv_text_survives_quotes_commas_and_line_breaks(wh):
    reviews = {(r["review_id"], r["order_id"]): r for r in wh.stage("order_reviews").collect()}
    assert reviews["r1", "o1"]["review_comment_message"] == 'said "good", twice\non two lines'
    assert reviews["r1", "o2"]["review_comment_message"] is None
    assert str(reviews["r1", "o1"]["ingestion_timestamp"]) == "2018-11-01 00:00:00"


def test_csv_columns_are_found_by_name_and_bom_is_skipped(wh):
    assert rows(wh.stage("sellers"), "seller_id", "seller_state") == [("s1", "SP"), ("s2", "rj")]
    assert rows(wh.stage("category_translation"), "product_category_name")[0] == ("beleza",)
    assert wh.stage("order_items").schema["price"].dataType == schemas.MONEY
    assert wh.stage("geolocation").first()["geolocation_zip_code_prefix"] == "01037"


def test_staged_views(spark, wh):
    names = register_views(wh.sources, wh.snapshot_time)
    assert len(names) == 9
    assert spark.sql("select count(*) as n from stg_orders").first()["n"] == 4


def test_moments_do_not_depend_on_the_session_zone(spark, wh):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        order = wh.stage("orders").filter("order_id = 'o1'").first()
        assert str(order["ingestion_timestamp"]) == "2018-11-01 00:00:00"
        assert str(order["order_purchase_timestamp"]) == "2017-01-01 10:30:00"
        assert wh.plan("dim_date").filter("date_key = 20170312").first()["day_name"] == "Sunday"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dim_date(spark, wh):
    days = wh["dim_date"]
    assert days.count() == 1096 + 1
    last = days.filter("date_key = 20181231").first().asDict()
    assert last["week_of_year"] == 1 and last["day_of_week"] == 1 and last["is_weekend"] is False
    first = days.filter("date_key = 20160101").first().asDict()
    assert first["week_of_year"] == 53 and first["year_quarter"] == "2016-Q1"
    assert (first["month_name"], first["day_name"], first["year_month"]) == ("January", "Friday", "2016-01")
    unknown = days.filter("date_key = -1").first().asDict()
    assert unknown["full_date"] is None and unknown["month_name"] == "Unknown"
    assert dim_date(spark, wh.first_day, wh.first_day).count() == 2


def test_dim_geography(wh):
    assert rows(wh["dim_geography"]) == [
        (-1, -1, "unknown", "XX", "Unknown", None, None),
        (1, 1037, "sao paulo", "SP", "Sudeste", -24.0, -47.0),
        (2, 20000, "a", "ZZ", "Unknown", -22.0, -43.0),
    ]


def test_dim_customers_and_sellers(wh):
    assert rows(wh["dim_customers"]) == [
        (-1, "unknown", "unknown", None, -1, "unknown", "XX"),
        (1, "c1", "u1", 1037, 1, "sao paulo", "SP"),
        (2, "c2", "u1", 99999, -1, "nowhere", "RJ"),
        (3, "c3", "u2", 20000, 2, "rio", "RJ"),
    ]
    assert rows(wh["dim_sellers"]) == [
        (-1, "unknown", None, -1, "unknown", "XX"),
        (1, "s1", 1037, 1, "sao paulo", "SP"),
        (2, "s2", 20000, 2, "rio", "RJ"),
    ]


def test_dim_products(wh):
    shown = rows(wh["dim_products"], "product_id", "category", "category_pt", "volume_cm3", "size_band")
    assert shown == [
        ("p1", "health_beauty", "beleza", 4999, "Small"),
        ("p2", "sem_nome", "sem_nome", 5000, "Medium"),
        ("p3", "unknown", "unknown", None, "Unknown"),
        ("p4", "toys", "brinquedos", 20000, "Large"),
        ("unknown", "unknown", "unknown", None, "Unknown"),
    ]


def test_dim_order_status_and_payment_type(wh):
    assert rows(wh["dim_order_status"]) == [
        (-1, "unknown", "Unknown", False, False, 9),
        (1, "canceled", "Cancelled", False, True, 7),
        (2, "delivered", "Delivered", True, False, 6),
        (3, "mystery", "mystery", False, False, 9),
        (4, "shipped", "Shipped", False, False, 5),
    ]
    assert rows(wh["dim_payment_type"]) == [
        (-1, "unknown", "Unknown", False, False),
        (1, "credit_card", "Credit card", True, True),
        (2, "gift_card", "gift card", False, True),
        (3, "not_defined", "Not defined", False, False),
        (4, "voucher", "Voucher", False, True),
    ]


def items(wh):
    return {(r["order_id"], r["order_item_id"]): r for r in wh["fact_order_items"].collect()}


def test_fact_order_items(wh):
    facts = items(wh)
    assert len(facts) == wh["fact_order_items"].count() == 6  # one copy removed
    noon = facts["o1", 1]
    assert (noon["is_late_delivery"], noon["delivery_delay_days"]) == (1, 0)
    assert (noon["delivery_days"], noon["seller_processing_days"], noon["carrier_transit_days"]) == (9, 2, 7)
    assert noon["purchase_hour"] == 10 and str(noon["total_item_value"]) == "110.00"
    assert noon["buyer_seller_distance_km"] == pytest.approx(0, abs=1e-3)
    assert facts["o1", 2]["buyer_seller_distance_km"] == pytest.approx(467, abs=5)
    assert facts["o4", 1]["is_late_delivery"] == 1


def test_missing_members_become_unknown_and_keep_the_row(wh):
    facts = items(wh)
    assert facts["o4", 1]["product_key"] == -1
    assert facts["o3", 1]["seller_key"] == -1 and facts["o3", 1]["seller_geography_key"] == -1
    assert facts["o2", 1]["customer_geography_key"] == -1
    assert facts["o2", 1]["buyer_seller_distance_km"] is None
    assert facts["o2", 1]["delivered_date_key"] == -1 and facts["o2", 1]["is_late_delivery"] is None
    assert facts["o3", 1]["purchase_date_key"] == -1  # before the calendar
    lost = facts["oX", 1]
    assert (lost["customer_key"], lost["order_status_key"], lost["purchase_date_key"]) == (-1, -1, -1)
    assert lost["purchase_hour"] is None and lost["delivery_days"] is None


def test_fact_order_payments(wh):
    shown = rows(
        wh["fact_order_payments"], "order_id", "payment_sequential",
        F.col("instalment_amount").cast("string"), "is_split_payment", "is_instalment_plan",
    )
    assert shown == [
        ("o1", 1, "20.01", False, True),
        ("o1", 2, "45.45", True, False),
        ("o2", 1, None, False, False),
        ("o4", 1, "18.33", False, True),
    ]


def test_fact_order_reviews(wh):
    shown = rows(
        wh["fact_order_reviews"], "review_id", "order_id", "review_created_date_key",
        "response_hours", "has_comment", "comment_length", "is_positive", "is_negative",
    )
    assert shown == [
        ("r1", "o1", 20170111, 1, 1, 31, 1, 0),
        ("r1", "o2", 20170221, 29, 0, 0, 0, 1),
        ("r2", "o1", -1, 0, 1, 4, 0, 0),
    ]


def test_every_fact_row_resolves_and_revenue_is_the_same_by_any_dimension(wh):
    facts = wh["fact_order_items"]
    total = facts.agg(F.sum("price")).first()[0]
    for dimension, key, fact_key in [
        ("dim_date", "date_key", "purchase_date_key"),
        ("dim_products", "product_key", "product_key"),
        ("dim_customers", "customer_key", "customer_key"),
        ("dim_sellers", "seller_key", "seller_key"),
        ("dim_geography", "geography_key", "customer_geography_key"),
        ("dim_order_status", "order_status_key", "order_status_key"),
    ]:
        side = wh[dimension].select(F.col(key).alias("k"))
        assert facts.join(side, F.col(fact_key) == F.col("k")).agg(F.sum("price")).first()[0] == total


def test_build_only_if_missing(spark, raw_folder, wh, tmp_path):
    assert wh.build().log == ()
    fresh = Warehouse(spark, csv_sources(spark, f"{raw_folder}/{{name}}.csv"), str(tmp_path))
    assert fresh["dim_sellers"].count() == 3
    assert not fresh.ready()  # only what was asked for, and what it needs
    report = fresh.build()
    assert report.ok and not any(line.startswith("dim_sellers") for line in report.log)
    again = fresh.build(if_missing=False)
    assert again.ok and len(again.log) == 10
    assert rows(fresh["dim_products"]) == rows(wh["dim_products"])


@pytest.mark.parametrize("broken", ["dim_geography", "dim_payment_type", "fact_order_items", "fact_order_reviews"])
def test_a_failed_rebuild_leaves_the_old_warehouse(spark, raw_folder, tmp_path, broken):
    sources = dict(csv_sources(spark, f"{raw_folder}/{{name}}.csv"))
    old = Warehouse(spark, sources, str(tmp_path))
    assert old.build().ok
    before = rows(old["fact_order_items"], "order_id", "order_item_id", "customer_key")
    customers = sources["customers"]
    first = spark.createDataFrame([("c0", "u0", "01037", "x", "SP")], customers().schema)
    changed = Warehouse(spark, {**sources, "customers": lambda: customers().unionByName(first)}, str(tmp_path))
    plan = changed.plan
    changed.plan = lambda name: 1 / 0 if name == broken else plan(name)
    report = changed.build(if_missing=False)
    assert not report.ok and report.log[-1].startswith(broken)
    for seen in (old, changed, Warehouse(spark, sources, str(tmp_path))):
        assert seen.ready() and seen.build().log == ()
        assert rows(seen["fact_order_items"], "order_id", "order_item_id", "customer_key") == before
        assert seen["dim_customers"].count() == 4
    changed.plan = plan
    assert changed.build(if_missing=False).ok
    assert old["dim_customers"].count() == 5 and [p.name for p in tmp_path.rglob("work")] == []
    keys = {r.customer_key: r.customer_id for r in old["dim_customers"].collect()}
    assert {r.order_id: keys[r.customer_key] for r in old["fact_order_items"].collect()}["o1"] == "c1"


def test_a_hot_order_is_spread_over_files(spark, work):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = spark.range(0, 6000, 1, 4).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("order_id"),
            F.col("id").alias("line"),
            F.when(F.col("id") % 3 == 0, 20170101).otherwise(20170101 + F.col("id") % 300).alias("day"),
            F.lit(2017).alias("year"),
        )
        out = work.write("hot", lines, ["year"], ["day", "order_id", "line"])
        files = out.withColumn("file", F.input_file_name())
        hot = files.filter("order_id = -1").groupBy("file").count().collect()
        assert len(hot) > 1 and sum(r["count"] for r in hot) == 2000
        assert out.count() == 6000
        # Every other order lies in one file.
        spread = files.filter("order_id <> -1").groupBy("order_id").agg(F.countDistinct("file").alias("n"))
        assert spread.filter("n > 1").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_unknown_table_is_an_error(wh):
    with pytest.raises(KeyError):
        wh["dim_moon"]


def test_catalog(spark, wh, tmp_path):
    tables = {name: wh[name] for name in schemas.WAREHOUSE_TABLES}
    assert not catalog.has_tables(spark, [*tables, "no_such_table"])
    catalog.register(tables)
    assert catalog.has_tables(spark, list(tables))
    listed = [r["table_name"] for r in catalog.list_tables(spark).collect()]
    assert set(tables) <= set(listed) and listed == sorted(listed)
    counts = dict(rows(catalog.row_counts(tables)))
    assert counts["fact_order_items"] == 6 and counts["dim_products"] == 5
    assert counts["(all tables)"] == sum(v for k, v in counts.items() if k != "(all tables)")
    described = rows(catalog.describe(wh["dim_sellers"]))
    assert described[0] == (1, "seller_key", "bigint") and len(described) == 6
    assert catalog.preview(wh["fact_order_items"], 2).count() == 2
    assert catalog.to_client(wh["dim_sellers"], ready=False).empty
    assert len(catalog.to_client(wh["dim_sellers"])) == 3
    path = catalog.export_csv(wh["dim_products"], str(tmp_path / "out"), rows=None)
    back = scan_csv(spark, path, wh["dim_products"].schema)
    assert rows(back) == rows(wh["dim_products"])


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")
