"""Run queries and their SQL side by side and compare rows and types."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
# Spark type -> the types of the other engine that hold the same values
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else v) for v in row)


def compare(df, con, sql: str) -> list[str]:
    """What differs, as text; an empty list means equal."""
    problems = []
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    columns = sorted(df.columns)
    if columns != sorted(names):
        return [f"columns {columns} against {sorted(names)}"]
    for name, kind in df.dtypes:
        if kinds[name] not in SAME_TYPE.get(kind, {kind}):
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_key)
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in theirs), key=_key)
    if len(ours) != len(theirs):
        return problems + [f"{len(ours)} rows against {len(theirs)}"]
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {columns}: {wrong[0]}")
    return problems


def main(folder: str, only: list[str]) -> int:
    import __spark_entry__ as contract
    from tallyhouse.session import build_session

    spark = build_session(
        "local[8]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = contract.oracle_sql()
    failed = 0
    for name, query in contract.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        began = time.monotonic()
        try:
            problems = compare(query(spark, folder), con, sqls[name]) if name in sqls else ["no SQL"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.monotonic() - began:.1f}s {problems or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
