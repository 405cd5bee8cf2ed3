"""Batch load into the raw table.

Rows lie in `raw/<table>/batch_id=B/try=N-x`, tables `staged`, `rejected` and `products`; the commit log in `raw/_commits`
says which try of each batch counts. All three directories of a batch become valid by one commit, after they are
written, and a repeated batch replaces its former rows by another one. `read_raw` sees the batches of one version; what a
running or killed load has written is not seen.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..operators.keyed import append_new, flag_rows, load_rules, rows_to_compare
from ..schema import ORDER_COLUMNS, RAW_COLUMNS, conform, struct_of
from ..sources.commits import CommitLog, Conflict, children
from ..sources.tables import Lakehouse, remove, write_table

KEYS = ["code"]
STAGED_COLUMNS = RAW_COLUMNS + ORDER_COLUMNS
RAW_SCHEMA = struct_of([c for c in RAW_COLUMNS if c != "batch_id"] + ["source", "batch_id"])
STAGED_SCHEMA = T.StructType(
    [*struct_of([c for c in STAGED_COLUMNS if c != "batch_id"] + ["source"]).fields,
     T.StructField("reject_reason", T.StringType()), T.StructField("batch_id", T.StringType())]
)
QUARANTINE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("file_path", "body", "batch_id")])
TABLES = ("staged", "rejected", "products", "quarantine")
DEFAULT_SOURCE = "csv"


@dataclass(frozen=True)
class LoadCounts:
    """What became of a batch. `loaded` counts accepted rows, those already known included."""

    received: int
    rejected: int
    inserted: int

    @property
    def loaded(self) -> int:
        return self.received - self.rejected


def with_defaults(df: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Column defaults of the raw table: `source`, and the load time where it is missing."""
    known = F.col("source") if "source" in df.columns else F.lit(None).cast("string")
    return df.withColumns(
        {
            "source": F.coalesce(known, F.lit(source)),
            "ingested_at": F.coalesce(F.col("ingested_at"), F.current_timestamp()),
        }
    )


class RawLog:
    """State of the raw layer: which directory of each table holds the rows of each batch.

    An entry names the directories of one batch; every `FULL_EVERY`th names those of all batches, so that a reader opens
    few files.
    """

    FULL_EVERY = 32

    def __init__(self, lake: Lakehouse):
        self.lake = lake
        self.log = CommitLog(lake.spark, lake.path("raw", "").rstrip("/"))

    def state(self, version: int | None = None) -> tuple[int, dict[str, dict[str, str]]]:
        """(version, batch -> table -> try) at a version, default the last one."""
        last = self.log.version()
        at = last if version is None else version
        if not 0 <= at <= last:
            raise ValueError(f"the raw layer has no version {at}")
        full = at - at % self.FULL_EVERY
        batches: dict[str, dict[str, str]] = {}
        if full:
            batches = dict(self.log.entry(full)["all"])
        for _, entry in self.log.entries(full, at):
            batches[entry["batch"]] = entry["tries"]
        return at, batches

    def commit(self, version: int, batches: dict[str, dict[str, str]], batch_id: str, tries: dict[str, str]) -> None:
        entry: dict = {"batch": batch_id, "tries": tries}
        if version % self.FULL_EVERY == 0:
            entry["all"] = {**batches, batch_id: tries}
        self.log.commit(version, entry)

    def rows(self, table: str, schema: T.StructType, batches: dict[str, dict[str, str]]) -> DataFrame:
        """Rows of the given batches; only their directories are listed."""
        root = self.lake.path("raw", table)
        paths = [f"{root}/batch_id={b}/try={tries[table]}" for b, tries in sorted(batches.items()) if table in tries]
        if not paths:
            return self.lake.spark.createDataFrame([], schema)
        found = self.lake.spark.read.schema(schema).option("basePath", root).parquet(*paths)
        return found.select(*schema.names)


def read_raw(lake: Lakehouse, version: int | None = None) -> DataFrame:
    """The raw products at a version of the commit log, default the last one."""
    log = RawLog(lake)
    return log.rows("products", RAW_SCHEMA, log.state(version)[1])


def read_rejected(lake: Lakehouse, version: int | None = None) -> DataFrame:
    """Rows set aside, with `reject_reason`."""
    log = RawLog(lake)
    return log.rows("rejected", STAGED_SCHEMA, log.state(version)[1])


def read_quarantine(lake: Lakehouse, version: int | None = None) -> DataFrame:
    """Unreadable pages of the batches, as the incremental ingest set them aside."""
    log = RawLog(lake)
    return log.rows("quarantine", QUARANTINE_SCHEMA, log.state(version)[1])


def load_raw(
    lake: Lakehouse, cleaned: DataFrame, batch_id: str, quarantine: DataFrame | None = None, attempts: int = 20
) -> LoadCounts:
    """Append the new keys of a cleaned batch; of several rows with one key the first in reading order.

    The cleaned rows are written once; validation and first-wins then read that table instead of parsing the landed files
    again, and the counts are observed while rows are written. Rows without any place in the reading order
    raise, as the choice among them would be left to chance.

    The new keys are found against one version of the raw table. When another load commits first, they are found again
    against its version, so a key never enters twice; after `attempts` lost races `Conflict` is raised. `quarantine` rows
    (path and body) become visible with the batch.
    """
    if not re.fullmatch(r"[\w.-]+", batch_id):
        raise ValueError(f"batch id is not a plain name: {batch_id}")
    log = RawLog(lake)
    version, batches = log.state()
    stamped = conform(cleaned, STAGED_COLUMNS).withColumn("batch_id", F.lit(batch_id))
    flagged = flag_rows(with_defaults(stamped), load_rules(stamped.columns + ["source"])).select(*STAGED_SCHEMA.names)
    tries: dict[str, str] = {}

    def write(table: str, rows: DataFrame, *counts: Column) -> dict[str, int]:
        """Write a new try of the batch and return what was counted on the way."""
        tries[table] = f"{version + 1}-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        rows = rows.drop("batch_id").observe(seen, *counts) if counts else rows.drop("batch_id")
        path = f"{lake.path('raw', table)}/batch_id={batch_id}/try={tries[table]}"
        write_table(rows, path, mode="errorifexists", index=KEYS[0] if table == "products" else None)
        return seen.get if counts else {}

    counts = write(
        "staged", flagged, F.count(F.lit(1)).alias("received"), F.count("reject_reason").alias("rejected"),
        F.count_if(F.coalesce(*[F.col(c).cast("string") for c in ORDER_COLUMNS]).isNull()).alias("unordered"),
    )
    if counts["unordered"]:
        raise ValueError(f"{counts['unordered']} rows of {batch_id} lack a reading order ({', '.join(ORDER_COLUMNS)})")
    staged = log.rows("staged", STAGED_SCHEMA, {batch_id: tries})
    write("rejected", staged.where(F.col("reject_reason").isNotNull()))
    good = staged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    if quarantine is not None:
        write("quarantine", quarantine)

    for _ in range(attempts):
        others = {b: t for b, t in batches.items() if b != batch_id}
        stored = rows_to_compare(log.rows("products", RAW_SCHEMA, others), good, KEYS[0])
        fresh = append_new(stored, good, KEYS, ORDER_COLUMNS).drop(*ORDER_COLUMNS)
        inserted = write("products", fresh, F.count(F.lit(1)).alias("inserted"))["inserted"]
        try:
            log.commit(version + 1, batches, batch_id, tries)
        except Conflict:
            version, batches = log.state()
            continue
        return LoadCounts(counts["received"], counts["rejected"], inserted)
    raise Conflict(f"{batch_id}: lost {attempts} races")


def drop_dead_tries(lake: Lakehouse, older_than: timedelta = timedelta(days=1)) -> list[str]:
    """Remove directories that no commit names and return their paths.

    They are what killed loads and lost races left. A load that still runs has directories of that kind too, so
    only those count whose intended version exists by now and that were last touched longer ago than any load takes.
    What an older version reads is named by its commit and stays.
    """
    log = RawLog(lake)
    last = log.log.version()
    named = {t for _, entry in log.log.entries() for t in entry["tries"].values()}
    before = datetime.now(timezone.utc) - older_than
    dead = []
    for table in TABLES:
        root = lake.path("raw", table)
        for batch, _ in children(lake.spark, root):
            for name, touched in children(lake.spark, f"{root}/{batch}"):
                number = re.match(r"try=(\d+)-", name)
                if number and int(number[1]) <= last and name[4:] not in named and touched < before:
                    dead.append(f"{root}/{batch}/{name}")
    for path in dead:
        remove(lake.spark, path)
    return dead
