"""Data-quality checks. Each returns its violations; no rows means passed."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.rows import hash_of, hashes_again
from tallyhouse.plans.checks import ACCEPTED, DURATIONS, GRAINS, NOT_NULL, PARENTS, UNIQUE
from tallyhouse.plans.warehouse import Warehouse

STAGED_OF = {
    "fact_order_items": "order_items",
    "fact_order_payments": "order_payments",
    "fact_order_reviews": "order_reviews",
}


# --- operators on any table --------------------------------------------------
def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _stacked(cells: Sequence[Mapping[str, str]]) -> str:
    """SQL that turns one row into one row per cell ({name: expression})."""
    structs = [
        "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in cell.items()) + ")"
        for cell in cells
    ]
    return f"inline(array({', '.join(structs)}))"


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def repeated_values(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """(table, column, value, n) of values that repeat in a column that must not.

    NULLs may repeat. All columns of all tables are counted in one shuffle, and
    within each task first, so a value with very many copies is one row there.
    """
    cells = [
        tables[table].selectExpr(
            f"'{table}' as table",
            _stacked([{"column": f"'{c}'", "value": f"cast({c} as string)"} for c in names]),
        )
        for table, names in columns.items()
    ]
    return duplicates(_union(cells).filter(F.col("value").isNotNull()), ["table", "column", "value"])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls) for the columns that hold NULLs; one pass for all."""
    counts = df.agg(*[F.expr(f"count_if({c} is null) as {c}") for c in columns])
    cells = [{"column": f"'{c}'", "nulls": c} for c in columns]
    return counts.selectExpr(_stacked(cells)).filter("nulls > 0")


Link = tuple[str, str]  # a parent table and its key column
Domain = tuple[int, int, bool]  # lowest and highest key, and whether −1 is a key too


def dense_domains(table: Callable[[str], DataFrame], links: Iterable[Link]) -> dict[Link, Domain]:
    """For each parent key without gaps, its lowest and highest value and whether −1 is a key.

    A key is dense if its values from zero on are a whole range, and none but −1 is below.
    Each value is one bit of a bitmap, so the proof is exact: as many bits as the range is
    long. A row per parent comes to the driver. Keys with gaps are left out.
    """
    above, below = [], []
    for parent, key in sorted(set(links)):
        keys = table(parent).select(
            F.lit(parent).alias("parent"), F.lit(key).alias("key"), F.col(key).cast("bigint").alias("k")
        )
        above.append(keys.filter("k >= 0"))
        below.append(keys.filter("k < 0"))
    bits = _union(above).groupBy("parent", "key", F.bitmap_bucket_number("k").alias("bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("k"))).alias("n"),
        F.min("k").alias("low"), F.max("k").alias("high"),
    )
    ranges = bits.groupBy("parent", "key").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    others = _union(below).groupBy("parent", "key").agg(F.min("k").alias("least"), F.max("k").alias("most"))
    found = {}
    for r in ranges.join(others, ["parent", "key"], "left").collect():
        if r.n != r.high - r.low + 1 or (r.least is not None and (r.least, r.most) != (-1, -1)):
            continue
        found[r.parent, r.key] = (r.low, r.high, r.least is not None)
    return found


def _within(column: str, domain: Domain) -> Column:
    low, high, unknown = domain
    inside = F.col(column).between(low, high)
    return inside | (F.col(column) == -1) if unknown else inside


def outside_domains(
    children: Mapping[str, DataFrame], parents: Mapping[str, Mapping[str, Link]], dense: Mapping[Link, Domain]
) -> DataFrame:
    """The rows of :func:`orphans` for keys of dense parents, without a join.

    Each child is scanned once; only keys that violate are shuffled.
    """
    wrong = F.lit(False)
    for (parent, key), domain in dense.items():
        wrong = wrong | ((F.col("parent") == f"{parent}.{key}") & ~_within("value", domain))
    found = [
        children[name].selectExpr(
            f"'{name}' as table",
            _stacked(
                [
                    {"column": f"'{c}'", "parent": f"'{parent}.{key}'", "value": f"cast({c} as bigint)"}
                    for c, (parent, key) in links.items()
                ]
            ),
        ).filter(wrong)
        for name, links in parents.items()
    ]
    return _union(found).groupBy("table", "column", "value").agg(F.count(F.lit(1)).alias("rows"))


def split_links(
    parents: Mapping[str, Mapping[str, Link]], dense: Mapping[Link, Domain]
) -> tuple[dict[str, dict[str, Link]], dict[str, dict[str, Link]]]:
    """The links to dense parents, and the others; tables without any are left out of a part."""
    parts: tuple[dict, dict] = ({}, {})
    for name, links in parents.items():
        for column, link in links.items():
            parts[link not in dense].setdefault(name, {})[column] = link
    return parts


def orphans(
    children: Mapping[str, DataFrame],
    parents: Mapping[str, Mapping[str, Link]],
    table: Callable[[str], DataFrame],
) -> DataFrame:
    """(table, column, value, rows) of non-NULL keys missing in their parent.

    ``parents`` maps a table and its key column to (parent, parent key). Each
    child is scanned once for all its keys. Values are counted inside each task
    before the shuffle, so a key that most rows share is one row there, and the
    anti join runs on distinct keys.
    """
    used = [
        children[name].selectExpr(
            f"'{name}' as table",
            _stacked(
                [
                    {
                        "column": f"'{column}'",
                        "parent": f"'{parent}'",
                        "value": f"cast({column} as bigint)",
                    }
                    for column, (parent, _) in links.items()
                ]
            ),
        )
        for name, links in parents.items()
    ]
    counted = (
        _union(used)
        .filter(F.col("value").isNotNull())
        .groupBy("table", "column", "parent", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    keys = sorted({link for links in parents.values() for link in links.values()})
    known = [
        table(parent).select(F.lit(parent).alias("parent"), F.col(key).cast("bigint").alias("value"))
        for parent, key in keys
    ]
    missing = counted.join(_union(known), ["parent", "value"], "left_anti")
    return missing.select("table", "column", "value", "rows")


def linked(
    children: Mapping[str, DataFrame],
    parents: Mapping[str, Mapping[str, Link]],
    table: Callable[[str], DataFrame],
) -> DataFrame:
    """The rows of :func:`orphans`, by range where the parent is dense, else by its join."""
    dense = dense_domains(table, {link for links in parents.values() for link in links.values()})
    by_range, by_join = split_links(parents, dense)
    found = []
    if by_range:
        found.append(outside_domains(children, by_range, dense))
    if by_join:
        found.append(orphans(children, by_join, table))
    return _union(found)


def outside(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """(value, n) of non-NULL values that are not accepted."""
    wrong = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(accepted)))
    return wrong.groupBy(F.col(column).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- the checks of the warehouse ---------------------------------------------
def unique_violations(wh: Warehouse) -> DataFrame:
    return repeated_values({table: wh[table] for table in UNIQUE}, UNIQUE)


def null_violations(wh: Warehouse) -> DataFrame:
    return _union(
        [
            null_counts(wh[table], columns).select(F.lit(table).alias("table"), "column", "nulls")
            for table, columns in NOT_NULL.items()
        ]
    )


def relationship_violations(wh: Warehouse) -> DataFrame:
    """Surrogate keys without gaps are compared with their range; other keys (days) are joined."""
    return linked({table: wh[table] for table in PARENTS}, PARENTS, lambda name: wh[name])


def accepted_violations(wh: Warehouse) -> DataFrame:
    return _union(
        [
            outside(wh[table], column, values).select(
                F.lit(table).alias("table"), F.lit(column).alias("column"), "value", "n"
            )
            for (table, column), values in ACCEPTED.items()
        ]
    )


def grain_violations(wh: Warehouse) -> DataFrame:
    """Fact rows that share their grain, with the grain as text.

    A hash per row is shuffled; only rows whose hash occurs again are counted by the grain.
    """

    def suspects(table: str, keys: Sequence[str]) -> DataFrame:
        again, _, _ = hashes_again(wh[table], keys, wh.work)
        return wh[table].withColumn("_key", hash_of(keys)).join(again, "_key", "left_semi")

    return _union(
        [
            duplicates(suspects(table, keys), keys).select(
                F.lit(table).alias("table"),
                F.concat_ws(" / ", *[F.col(k).cast("string") for k in keys]).alias("grain"),
                "n",
            )
            for table, keys in GRAINS.items()
        ]
    )


def row_counts(wh: Warehouse) -> DataFrame:
    """Rows of each fact and of its staged source, side by side."""

    def count(df: DataFrame, table: str, side: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(table).alias("table_name"),
            *[(F.col("n") if name == side else F.lit(0).cast("bigint")).alias(name) for name in sides],
        )

    sides = ["warehouse_rows", "source_rows"]
    counts = _union(
        [
            count(df, fact, side)
            for fact, source in STAGED_OF.items()
            for df, side in zip((wh.footers(fact), wh.stage(source)), sides)
        ]
    )
    return counts.groupBy("table_name").agg(*[F.sum(side).alias(side) for side in sides])


def lost_rows(wh: Warehouse) -> DataFrame:
    return row_counts(wh).filter(F.col("warehouse_rows") != F.col("source_rows"))


def accounts(wh: Warehouse) -> DataFrame:
    """Per fact: records of the source, those rejected when read, rows, and what is unaccounted for.

    Sources that reject nothing have 0 rejected records, and as many records as rows.
    """

    def count(name: str) -> DataFrame:
        rejected = getattr(wh.sources[name], "rejected", None)
        one = rejected() if rejected else wh.spark.createDataFrame([], "record string")
        return one.agg(F.count(F.lit(1)).alias("rejected_records"))

    set_aside = _union([count(source).select(F.lit(fact).alias("table_name"), "rejected_records") for fact, source in STAGED_OF.items()])
    return row_counts(wh).join(set_aside, "table_name").select(
        "table_name",
        (F.col("source_rows") + F.col("rejected_records")).alias("records"),
        "rejected_records",
        "warehouse_rows",
        (F.col("source_rows") - F.col("warehouse_rows")).alias("unaccounted"),
    )


def revenue_totals(wh: Warehouse) -> DataFrame:
    """Item value in the warehouse and in the source, to the cent."""

    def total(df: DataFrame, value, side: str) -> DataFrame:
        summed = df.agg(F.round(F.sum(value), 2).cast("decimal(38,2)").alias("total"))
        return summed.select(*[F.when(F.lit(name == side), F.col("total")).alias(name) for name in sides])

    sides = ["warehouse_total", "source_total"]
    stored = total(wh["fact_order_items"], F.col("total_item_value"), sides[0])
    given = total(wh.stage("order_items"), F.col("price") + F.col("freight_value"), sides[1])
    return stored.unionByName(given).agg(*[F.max(side).alias(side) for side in sides])


def revenue_mismatch(wh: Warehouse) -> DataFrame:
    return revenue_totals(wh).filter(F.col("warehouse_total") != F.col("source_total"))


def negative_durations(wh: Warehouse, columns: Sequence[str] = DURATIONS) -> DataFrame:
    """(column, rows) of durations below zero; an extra, optional check."""
    items = wh["fact_order_items"]
    counts = items.agg(*[F.expr(f"count_if({c} < 0) as {c}") for c in columns])
    cells = [{"column": f"'{c}'", "rows": c} for c in columns]
    return counts.selectExpr(_stacked(cells)).filter("rows > 0")


def cell_counts(df: DataFrame, table: str, dense: Mapping[Link, Domain]) -> DataFrame:
    """(check, table, column, violations) of all that a row alone decides, in one pass over a table.

    NULLs where none may be, keys outside a dense parent, and how many different values are not accepted.
    """
    counts = {("not_null", c): F.count_if(F.col(c).isNull()) for c in NOT_NULL.get(table, [])}
    for c, link in PARENTS.get(table, {}).items():
        if link in dense:
            counts["relationships", c] = F.count_if(~_within(c, dense[link]))
    for (of, c), values in ACCEPTED.items():
        if of == table:
            counts["accepted_values", c] = F.count_distinct(F.when(~F.col(c).isin(list(values)), F.col(c)))
    names = {f"n{i}": found for i, found in enumerate(counts)}
    one = df.agg(*[counts[found].alias(name) for name, found in names.items()])
    cells = [
        {"check": f"'{check}'", "table": f"'{table}'", "column": f"'{c}'", "violations": name}
        for name, (check, c) in names.items()
    ]
    return one.selectExpr(_stacked(cells))


def report(wh: Warehouse) -> DataFrame:
    """One row per check and column: how many violations it found (0 = passed).

    What a row alone decides is counted in one pass per table; uniqueness and grain
    need a shuffle each, and keys of parents with gaps a join on counted keys.
    """
    dense = dense_domains(lambda name: wh[name], {link for links in PARENTS.values() for link in links.values()})
    by_join = split_links(PARENTS, dense)[1]

    def counted(df: DataFrame, check: str, rows: str | None = None) -> DataFrame:
        """Violations per table and column: reported rows, or the rows they stand for."""
        column = F.col("column") if "column" in df.columns else F.lit("")
        found = F.sum(rows) if rows else F.count(F.lit(1))
        return df.groupBy(
            F.lit(check).alias("check"), F.col("table"), column.alias("column")
        ).agg(found.alias("violations"))

    declared = [
        *[("unique", t, c) for t, columns in UNIQUE.items() for c in columns],
        *[("not_null", t, c) for t, columns in NOT_NULL.items() for c in columns],
        *[("relationships", t, c) for t, columns in PARENTS.items() for c in columns],
        *[("accepted_values", t, c) for t, c in ACCEPTED],
        *[("grain", t, "") for t in GRAINS],
        *[("rows_kept", t, "") for t in STAGED_OF],
        ("revenue", "fact_order_items", ""),
    ]
    expected = wh.spark.createDataFrame(declared, "check string, table string, column string")
    found = _union(
        [
            counted(unique_violations(wh), "unique"),
            *[cell_counts(wh[table], table, dense) for table in NOT_NULL],
            *(
                [counted(orphans({t: wh[t] for t in by_join}, by_join, lambda name: wh[name]), "relationships", "rows")]
                if by_join
                else []
            ),
            counted(grain_violations(wh), "grain"),
            counted(lost_rows(wh).withColumnRenamed("table_name", "table"), "rows_kept"),
            counted(
                revenue_mismatch(wh).withColumn("table", F.lit("fact_order_items")), "revenue"
            ),
        ]
    )
    # Both sides have one row per declared check.
    return (
        expected.join(found, ["check", "table", "column"], "left")
        .select(
            "check", "table", "column", F.coalesce("violations", F.lit(0)).alias("violations")
        )
        .orderBy("check", "table", "column")
    )
