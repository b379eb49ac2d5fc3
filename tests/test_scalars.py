from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse import fixed_values as fixed
from tallyhouse.functions import measures as M
from tallyhouse.functions import scalars as S


def one(spark, column, **values):
    """Evaluate a column over one row of literals given as (value, type)."""
    row = spark.range(1).select(*[F.lit(v).cast(t).alias(k) for k, (v, t) in values.items()])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize("value,label", [(None, "d"), (-1, "a"), (9, "a"), (10, "b"), (20, "c"), (30, "d")])
def test_bucketize_left_closed(spark, value, label):
    out = S.bucketize(F.col("v"), [10, 20, 30], ["a", "b", "c", "d"])
    assert one(spark, out, v=(value, "int")) == label


@pytest.mark.parametrize("value,label", [(0, "a"), (-1, "b"), (2, "b"), (3, "c"), (4, "c"), (5, "d")])
def test_bucketize_right_closed_with_exact_head(spark, value, label):
    out = S.bucketize(F.col("v"), [0, 2, 4], ["a", "b", "c", "d"], closed="right", exact_head=True)
    assert one(spark, out, v=(value, "int")) == label


def test_bucketize_refuses_wrong_arguments(spark):
    with pytest.raises(ValueError):
        S.bucketize(F.lit(1), [1, 2], ["a", "b"])
    with pytest.raises(ValueError):
        S.bucketize(F.lit(1), [1], ["a", "b"], closed="both")


def test_label_map_falls_back_to_the_words(spark):
    out = S.label_map(F.col("v"), fixed.PAYMENT_LABELS, S.plain_words(F.col("v")))
    assert one(spark, out, v=("boleto", "string")) == "Boleto (bank slip)"
    assert one(spark, out, v=("gift_card_x", "string")) == "gift card x"
    assert one(spark, out, v=(None, "string")) is None


def test_every_state_has_its_region(spark):
    states = [(s, r) for r, names in fixed.REGION_STATES.items() for s in names]
    assert len(states) == 27
    df = spark.createDataFrame(states + [("XX", "Unknown"), (None, "Unknown")], "state string, region string")
    assert df.filter(S.region_of_state(F.col("state")) != F.col("region")).count() == 0


def test_date_key_outside_and_missing(spark):
    key = S.date_key(F.col("v"), date(2016, 1, 1), date(2018, 12, 31))
    for text, expected in [
        ("2016-01-01 00:00:00", 20160101),
        ("2018-12-31 23:59:59", 20181231),
        ("2015-12-31 23:59:59", -1),
        ("2019-01-01 00:00:00", -1),
        (None, -1),
    ]:
        assert one(spark, key, v=(text, "timestamp_ntz")) == expected


@pytest.mark.parametrize(
    "a,b,hours",
    [
        ("2017-01-01 00:59:00", "2017-01-01 01:01:00", 1),
        ("2017-01-01 00:00:00", "2017-01-01 00:59:59", 0),
        ("2017-01-01 23:59:59", "2017-01-03 00:00:00", 25),
        ("2017-01-01 01:01:00", "2017-01-01 00:59:00", -1),
        (None, "2017-01-01 00:59:00", None),
    ],
)
def test_hour_boundaries(spark, a, b, hours):
    out = S.hour_boundaries(F.col("a"), F.col("b"))
    assert one(spark, out, a=(a, "timestamp_ntz"), b=(b, "timestamp_ntz")) == hours


def test_late_flag_has_three_values(spark):
    out = S.late_flag(F.col("a"), F.col("b"))
    noon, day = ("2017-01-10 12:00:00", "timestamp_ntz"), ("2017-01-10 00:00:00", "timestamp_ntz")
    assert one(spark, out, a=noon, b=day) == 1
    assert one(spark, out, a=day, b=day) == 0
    assert one(spark, out, a=(None, "timestamp_ntz"), b=day) is None
    assert one(spark, out, a=day, b=(None, "timestamp_ntz")) is None
    assert one(spark, S.days_between(F.col("b"), F.col("a")), a=noon, b=day) == 0


def test_great_circle(spark):
    out = S.great_circle_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))

    def km(a, b, c, d):
        return one(spark, out, a=(a, "double"), b=(b, "double"), c=(c, "double"), d=(d, "double"))

    assert km(-23.5, -46.6, -23.5, -46.6) == pytest.approx(0, abs=1e-3)
    assert km(0.0, 0.0, 0.0, 180.0) == pytest.approx(math.pi * 6371)
    assert km(0.0, 0.0, 1.0, 0.0) == pytest.approx(math.radians(1) * 6371)
    assert km(None, 0.0, 1.0, 0.0) is None
    assert km(1.0, 0.0, None, 0.0) is None


def test_ratio_of_nothing_is_null(spark):
    assert one(spark, S.ratio(F.col("a"), F.col("b")), a=(1, "int"), b=(0, "int")) is None


def test_percent_ignores_missing_flags(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (1,)], "v int")
    assert df.agg(S.percent(F.col("v")).alias("p")).first()["p"] == pytest.approx(200 / 3)


def test_sums_of_non_additive_measures_are_refused():
    with pytest.raises(ValueError, match="non-additive"):
        M.total("delivery_days")
    with pytest.raises(ValueError):
        M.share("price")


def test_tidy_names_trim_spaces_only(spark):
    assert one(spark, S.tidy_city(F.col("v")), v=("  Rio De ", "string")) == "rio de"
    assert one(spark, S.tidy_state(F.col("v")), v=(" sp", "string")) == "SP"


def test_flag_of_unknown_is_zero(spark):
    assert one(spark, S.flag(F.col("v") >= 4), v=(None, "int")) == 0


def test_snapshot_time_is_fixed():
    assert fixed.SNAPSHOT_TIME == datetime(2018, 11, 1)


def test_only_known_measures_are_summed():
    for name in ("purchase_hour", "no_such_measure"):
        with pytest.raises(ValueError):
            M.total(name)
