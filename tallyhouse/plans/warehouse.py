"""The warehouse: which table is built from which, and where it is kept."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Hashable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tallyhouse import fixed_values as fixed
from tallyhouse import schemas
from tallyhouse.plans import checks, dims, facts
from tallyhouse.sources.staging import staged
from tallyhouse.sources.tables import TableFolder


# Tables that need only what stands before them; those of one line are built at once.
WAVES = (
    ("dim_date", "dim_geography", "dim_products", "dim_order_status", "dim_payment_type"),
    ("dim_customers", "dim_sellers"),
    schemas.FACTS,
)


@dataclass(frozen=True)
class BuildReport:
    """``violations`` are (table, check, column, rows) that the writing jobs counted."""

    ok: bool
    log: tuple[str, ...]
    violations: tuple[tuple[str, str, str, int], ...] = ()


class Warehouse:
    """Ten written tables over nine raw ones.

    A table is built when it is first asked for, or all of them by ``build``.
    Written tables end the lineage and give Spark true sizes, from which it
    chooses between broadcast and shuffle joins.

    Each build has a folder of its own, order header and slices included, and is
    published by one marker when all ten tables are there. Readers see the newest
    published build or, where there is none, what this object has built so far.
    So tables of two builds are never mixed, and a failed build changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, Callable[[], DataFrame]],
        folder: str,
        first_day: date = fixed.CALENDAR_FIRST,
        last_day: date = fixed.CALENDAR_LAST,
        snapshot_time: datetime = fixed.SNAPSHOT_TIME,
    ):
        self.spark = spark
        self.sources = sources
        self.first_day = first_day
        self.last_day = last_day
        self.snapshot_time = snapshot_time
        self.folder = TableFolder(spark, folder)
        self.work = self.folder.below("work")
        self._draft: TableFolder | None = None
        self._read: dict[str, TableFolder] = {}
        self._remembered: dict[tuple[str, Hashable], DataFrame] = {}

    def remembered(self, key: Hashable, make: Callable[[], DataFrame]) -> DataFrame:
        """What ``make`` gives on the published build, written at the first call.

        It lies in the folder of that build and goes with it. Without a published
        build nothing is kept.
        """
        published = self.folder.marks("published")
        if not published:
            return make()
        place = (published[-1], key)
        if place not in self._remembered:
            kept = self.folder.below(published[-1]).below("remembered")
            self._remembered[place] = kept.write(uuid.uuid4().hex, make())
        return self._remembered[place]

    def stage(self, name: str) -> DataFrame:
        """A staged raw table, not materialised."""
        return staged(self.sources[name](), self.snapshot_time)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in schemas.WAREHOUSE_TABLES:
            raise KeyError(name)
        published = self.folder.marks("published")
        if not published:
            return self._drafted(name)
        newest = published[-1]
        if newest not in self._read:
            self._read[newest] = self.folder.below(newest)
        return self._read[newest].read(name)

    def footers(self, name: str) -> DataFrame:
        """A table of the published build for counts and bounds; see ``TableFolder.footers``."""
        table = self[name]
        published = self.folder.marks("published")
        return self._read[published[-1]].footers(name) if published else table

    def _new_draft(self) -> TableFolder:
        self._draft = self.folder.below(f"build-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
        return self._draft

    def _drafted(self, name: str) -> DataFrame:
        """A table of the build at hand, written if it is not yet there."""
        draft = self._draft or self._new_draft()
        if not draft.exists(name):
            self._write(draft, name)
        return draft.read(name)

    def _header(self) -> DataFrame:
        kept = (self._draft or self._new_draft()).below("work")
        if not kept.exists("order_header"):
            header = facts.order_header(
                self.stage("orders"),
                self._drafted("dim_customers"),
                self._drafted("dim_geography"),
                self._drafted("dim_order_status"),
                self.first_day,
                self.last_day,
                kept,
            )
            kept.write("order_header", header)
        return kept.read("order_header")

    def plan(self, name: str) -> DataFrame:
        """The rows of one table of the build at hand, before they are written."""
        stage, slices = self.stage, (self._draft or self._new_draft()).below("work")
        plans: dict[str, Callable[[], DataFrame]] = {
            "dim_date": lambda: dims.dim_date(self.spark, self.first_day, self.last_day),
            "dim_geography": lambda: dims.dim_geography(stage("geolocation"), slices),
            "dim_customers": lambda: dims.dim_customers(
                stage("customers"), self._drafted("dim_geography"), slices
            ),
            "dim_sellers": lambda: dims.dim_sellers(
                stage("sellers"), self._drafted("dim_geography"), slices
            ),
            "dim_products": lambda: dims.dim_products(
                stage("products"), stage("category_translation"), slices
            ),
            "dim_order_status": lambda: dims.dim_order_status(stage("orders"), slices),
            "dim_payment_type": lambda: dims.dim_payment_type(stage("order_payments"), slices),
            "fact_order_items": lambda: facts.fact_order_items(
                stage("order_items"),
                self._header(),
                self._drafted("dim_products"),
                self._drafted("dim_sellers"),
                self._drafted("dim_geography"),
                slices,
            ),
            "fact_order_payments": lambda: facts.fact_order_payments(
                stage("order_payments"), self._header(), self._drafted("dim_payment_type"), slices
            ),
            "fact_order_reviews": lambda: facts.fact_order_reviews(
                stage("order_reviews"), self._header(), self.first_day, self.last_day, slices
            ),
        }
        return plans[name]()

    def _write(self, draft: TableFolder, name: str) -> None:
        rows = self.plan(name)
        if name in schemas.FACTS:
            # As the join with the order header leaves them: the lines of an order lie
            # together, and are summed before any shuffle. Cutting them into ranges of
            # days would shuffle all rows of the widest tables once more. Files are
            # ordered by day, so a date range reads its years and few pages of each.
            draft.write(
                name,
                rows,
                partition_by=["purchase_year"],
                sort_by=["purchase_date_key", "order_id"],
                measures=checks.measures(name),
            )
        else:
            draft.write(name, rows, measures=checks.measures(name))

    def ready(self) -> bool:
        """True when a build with all ten tables has been published."""
        return bool(self.folder.marks("published"))

    def build(self, if_missing: bool = True, only_sound: bool = False) -> BuildReport:
        """Build in dependency order and publish; by default only if nothing is.

        What fails is reported, not raised, and leaves the published build as it was.
        Declared NULLs, values and durations are counted while the tables are written;
        with ``only_sound`` a build that violates one of them is not published either.
        """
        if if_missing and self.ready():
            return BuildReport(True, ())
        log: list[str] = []
        draft = self._draft if if_missing and self._draft else self._new_draft()

        def made(name: str) -> tuple[str, bool]:
            began = time.monotonic()
            try:
                self._drafted(name)
            except Exception as fault:
                return f"{name}: failed, {fault}", False
            return f"{name}: built in {time.monotonic() - began:.1f} s", True

        for wave in WAVES:
            names = [name for name in wave if not draft.exists(name)]
            if not names:
                continue
            if wave is schemas.FACTS:
                try:
                    self._header()  # all facts read it
                except Exception as fault:
                    self._draft = None
                    draft.remove()
                    return BuildReport(False, (*log, f"order_header: failed, {fault}"))
            with ThreadPoolExecutor(len(names)) as pool:
                done = list(pool.map(made, names))
            log += [line for line, ok in done if ok]
            failed = [line for line, ok in done if not ok]
            if failed:
                self._draft = None
                draft.remove()
                return BuildReport(False, (*log, *failed))
        found = tuple(checks.violations(draft.measured))
        if found and only_sound:
            self._draft = None
            draft.remove()
            return BuildReport(False, (*log, f"not published: {len(found)} checks are violated"), found)
        self._publish(draft)
        return BuildReport(True, tuple(log), found)

    def _publish(self, draft: TableFolder) -> None:
        """Make the build the one to be read; the one before stays for its readers."""
        draft.below("work").remove()
        self.folder.mark("published", draft.path.rsplit("/", 1)[-1])
        self._draft = None
        published = self.folder.marks("published")
        for name in published[:-2]:
            self.folder.below("published").below(name).remove()
        for name in self.folder.marks(""):
            # Older than the builds that stay: published once, or left by a build that was killed.
            if not name.startswith("build-") or name >= published[-2:][0]:
                continue
            self.folder.below(name).remove()
            self._read.pop(name, None)
            self._remembered = {k: df for k, df in self._remembered.items() if k[0] != name}
