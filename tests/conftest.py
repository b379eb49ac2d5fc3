from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyhouse.plans.warehouse import Warehouse  # noqa: E402
from tallyhouse.session import build_session  # noqa: E402
from tallyhouse.sources.staging import csv_sources  # noqa: E402
from tallyhouse.sources.tables import TableFolder  # noqa: E402

# The nine raw files in their own shape, with one row per awkward case.
FILES = {
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01037, Sao Paulo ,sp
c2,u1,99999,nowhere,rj
c3,u2,20000,Rio,RJ
c1,u1,01037, Sao Paulo ,sp
""",
    "sellers": """seller_state,seller_id,seller_zip_code_prefix,seller_city
SP,s1,01037,Sao Paulo
rj,s2,20000, RIO
""",
    "geolocation": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state
01037,-23.5,-46.5, Sao Paulo ,sp
01037,-24.5,-47.5,SAO PAULO,SP
01037,-24.0,-47.0,santos,SP
20000,-22.0,-43.0,b,zz
20000,-22.0,-43.0,a,zz
""",
    "products": """product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,beleza,10,100,1,300,1,1,4999
p2,sem_nome,10,100,0,2000,1,1,5000
p3,,10,100,,,,2,3
p4,brinquedos,10,100,7,12000,20,10,100
""",
    "category_translation": """﻿product_category_name,product_category_name_english
beleza,health_beauty
brinquedos,toys
""",
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2017-01-01 10:30:00,2017-01-01 11:00:00,2017-01-03 08:00:00,2017-01-10 12:00:00,2017-01-10 00:00:00
o2,c2,shipped,2017-02-05 23:00:00,,,,2017-02-20 00:00:00
o3,c3,canceled,2015-12-31 00:00:00,2015-12-31 01:00:00,,,2016-01-15 00:00:00
o4,c3,mystery,2018-03-01 05:00:00,2018-03-01 05:00:00,2018-03-02 05:00:00,2018-03-20 05:00:00,2018-03-10 00:00:00
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2017-01-05 00:00:00,100.00,10.00
o1,1,p1,s1,2017-01-05 00:00:00,100.00,10.00
o1,2,p4,s2,2017-01-05 00:00:00,100.00,35.50
o2,1,p2,s1,2017-02-10 00:00:00,0.00,5.00
o3,1,p3,sX,2016-01-05 00:00:00,20.00,2.00
o4,1,pX,s2,2018-03-05 00:00:00,50.00,4.99
oX,1,p1,s1,2018-03-05 00:00:00,60.00,6.00
""",
    "order_payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,10,200.05
o1,2,voucher,1,45.45
o2,1,not_defined,0,5.00
o4,1,gift_card,3,55.00
""",
    "order_reviews": """review_id,order_id,review_score,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,"said ""good"", twice
on two lines",2017-01-11 00:59:00,2017-01-11 01:01:00
r1,o2,2,,2017-02-21 00:00:00,2017-02-22 05:30:00
r2,o1,3,fine,2019-01-01 00:00:00,2019-01-01 00:00:00
""",
}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        "tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return folder


@pytest.fixture(scope="session")
def wh(spark, raw_folder, tmp_path_factory):
    sources = csv_sources(spark, f"{raw_folder}/{{name}}.csv")
    warehouse = Warehouse(spark, sources, str(tmp_path_factory.mktemp("warehouse")))
    assert not warehouse.ready()
    assert warehouse.build().ok
    return warehouse


@pytest.fixture
def work(spark, tmp_path):
    return TableFolder(spark, str(tmp_path))


def rows(df, *columns):
    """Rows as tuples, sorted, NULLs last."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda t: tuple((v is None, "" if v is None else v) for v in t),
    )
