"""Delimited files read in many blocks: records across their borders, and records that do not fit."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from tallyhouse import schemas
from tallyhouse.plans import quality
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.records import read_csv
from tallyhouse.sources.staging import record_sources, scan_csv
from tests.conftest import rows

REVIEWS = T.StructType(
    [T.StructField("review_id", T.StringType()), T.StructField("score", T.IntegerType()), T.StructField("text", T.StringType())]
)


@pytest.fixture
def small_blocks(spark):
    """Blocks of at most that many bytes; a line belongs to the block it begins in."""

    def cut(size: int):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(path, rng, n, end="\n", long_every=0):
    pieces = ["plain", 'say ""x""', "a,b", "", " lead", "trail ", "é", '""', "x\ny", f"one{end}two{end}{end}three", "\n\n"]
    out = ["review_id,score,text"]
    for i in range(n):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))
        if long_every and i % long_every == 3:
            text += "long\n" * 400
        out.append(f'r{i},{rng.randint(1, 5)},"{text}"' if text or i % 2 else f"r{i},,")
    path.write_bytes((end.join(out) + (end if n % 2 else "")).encode())


@pytest.mark.parametrize("size", [97, 700, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"], ids=["lf", "crlf"])
def test_records_equal_the_reader_of_whole_files(spark, tmp_path, work, small_blocks, size, end):
    rng = random.Random(size)
    folder = tmp_path / "reviews"
    folder.mkdir()
    written(folder / "a.csv", rng, 300, end, long_every=60)
    written(folder / "b.csv", rng, 151, end)
    written(folder / "c.csv", rng, 0, end)
    expected = rows(scan_csv(spark, str(folder), REVIEWS, multiline=True))
    small_blocks(size)
    found = read_csv(spark, str(folder), REVIEWS, work, "blocks")
    assert rows(found.rows) == expected and len(expected) == 451
    assert found.rejected.count() == 0
    if size < 1000:
        tasks = spark.read.text(str(folder)).rdd.getNumPartitions()
        assert tasks > 20
    # The only shuffle of text is by the block a record began in.
    plan = found.rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_quoted_break_exactly_at_the_border(spark, tmp_path, work, small_blocks):
    body = 'review_id,score,text\nr1,1,"ab\ncd"\nr2,2,x\nr3,3,"\n\n"\nr4,4,"a"",\n""b"\n'
    (tmp_path / "f.csv").write_text(body)
    expected = rows(scan_csv(spark, str(tmp_path / "f.csv"), REVIEWS, multiline=True))
    for size in range(20, len(body) + 2):
        small_blocks(size)
        assert rows(read_csv(spark, str(tmp_path / "f.csv"), REVIEWS, work, f"b{size}").rows) == expected, size


def test_records_that_do_not_fit_are_set_aside_with_reasons(spark, tmp_path, work):
    (tmp_path / "f.csv").write_text(
        '\ufeffscore,review_id,other\n1,a,x\n2.5,b,x\nfive,c,"two\nlines"\n4,d\n5,e,x,more\n\n,f,x\n"",g,x\n'
    )
    found = read_csv(spark, str(tmp_path / "f.csv"), REVIEWS, work, "blocks")
    assert rows(found.rows) == [("a", 1, None), ("f", None, None), ("g", None, None)]
    reasons = {r["record"]: r["reasons"] for r in found.rejected.collect()}
    assert reasons['five,c,"two\nlines"'] == "score is no int: five" and reasons["2.5,b,x"] == "score is no int: 2.5"
    assert "as many values" in reasons["4,d"] and "as many values" in reasons["5,e,x,more"] and len(reasons) == 4


def test_one_bad_date_costs_one_row_and_is_accounted_for(spark, raw_folder, tmp_path, work):
    folder = tmp_path / "raw"
    folder.mkdir()
    for f in raw_folder.iterdir():
        (folder / f.name).write_bytes(f.read_bytes())
    reviews = folder / "order_reviews.csv"
    reviews.write_text(reviews.read_text() + "r9,o1,4,late,soon,2019-01-01 00:00:00\n")
    sources = record_sources(spark, f"{folder}/{{name}}.csv", work)
    built = Warehouse(spark, sources, str(tmp_path / "warehouse"))
    report = built.build()
    assert report.ok, report.log
    assert built["fact_order_reviews"].count() == 3
    account = {r["table_name"]: r for r in quality.accounts(built).collect()}
    reviews_account = account["fact_order_reviews"]
    assert (reviews_account["records"], reviews_account["rejected_records"], reviews_account["unaccounted"]) == (4, 1, 0)
    assert account["fact_order_items"]["unaccounted"] == 1  # the copy of a line, dropped on purpose
    bad = built.sources["order_reviews"].rejected().collect()
    assert [r["reasons"] for r in bad] == ["review_creation_date is no timestamp_ntz: soon"]
    assert schemas.RAW["order_reviews"].names[0] == "review_id"
