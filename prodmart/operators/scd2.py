"""Slowly changing dimension, type 2, with the timestamp strategy.

Rules: a new key is inserted; a row newer than the open one closes it and is inserted; an equal
or older row changes nothing; a key missing from the input stays open. Of several input rows with
one key the newest counts; a missing key is a key like any other.

The history adds the columns `META`. A change column of the name `updated_at` is the history's own; any other input
column of one of these names is kept as `source_<name>`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.commits import CommitLog, Conflict
from ..sources.tables import path_exists, remove, store
from .keyed import first_wins

META = ["scd_id", "updated_at", "valid_from", "valid_to"]


def version_id(df: DataFrame, key: str, updated_at: str) -> Column:
    """Hash of the key and the change time. A moment counts in microseconds, so no session zone enters; other types as text."""
    moment = F.col(updated_at)
    if isinstance(df.schema[updated_at].dataType, T.TimestampType):
        moment = F.unix_micros(moment)
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), moment.cast("string")))


def own_columns(incoming: DataFrame, key: str, updated_at: str) -> tuple[DataFrame, str, str]:
    """The input, its key and its change column under names that do not clash with the history's."""
    clash = {c: f"source_{c}" for c in incoming.columns if c in META and not c == updated_at == "updated_at"}
    return incoming.withColumnsRenamed(clash), clash.get(key, key), clash.get(updated_at, updated_at)


def newest_per_key(incoming: DataFrame, key: str, updated_at: str) -> DataFrame:
    """One row per key: the newest, of equally new ones the least by its other columns."""
    comparable = [f.name for f in incoming.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return first_wins(incoming, [key], [F.col(updated_at).desc_nulls_last(), *comparable])


def _opened(rows: DataFrame, key: str, updated_at: str) -> DataFrame:
    moment = F.col(updated_at)
    return rows.select(
        *[c for c in rows.columns if c != "updated_at"],
        version_id(rows, key, updated_at).alias("scd_id"),
        moment.alias("updated_at"),
        moment.alias("valid_from"),
        F.lit(None).cast(rows.schema[updated_at].dataType).alias("valid_to"),
    )


def first_versions(incoming: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Every incoming row as an open version."""
    return _opened(*own_columns(incoming, key, updated_at))


def _newest_versions(incoming: DataFrame, key: str, updated_at: str) -> tuple[DataFrame, str]:
    """The newest row of every key as an open version, and the key's name."""
    rows, key, updated_at = own_columns(incoming, key, updated_at)
    return _opened(newest_per_key(rows, key, updated_at), key, updated_at), key


def merge_open(open_rows: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Open versions against new ones, at most one a key: a single full outer join.

    Returns rows still open and rows closed just now.
    """
    names = new.columns
    pairs = open_rows.select(F.col(key).alias("_old_key"), F.struct(*names).alias("_old")).join(
        new.select(F.col(key).alias("_new_key"), F.struct(*names).alias("_new")),
        F.col("_old_key").eqNullSafe(F.col("_new_key")),
        "full_outer",
    )
    newer = F.col("_new.updated_at") > F.col("_old.updated_at")
    kept = F.col("_old").withField("valid_to", F.when(newer, F.col("_new.updated_at")))
    versions = F.array(
        F.when(F.col("_old").isNotNull(), kept),
        F.when(F.col("_new").isNotNull() & (F.col("_old").isNull() | newer), F.col("_new")),
    )
    return pairs.select(F.explode(versions).alias("v")).where("v IS NOT NULL").select("v.*")


def scd2_apply(current: DataFrame | None, incoming: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The whole history after one input; closed versions pass by without a shuffle. The shuffle of the join
    with the open ones also serves to pick each key's newest row."""
    new, key = _newest_versions(incoming, key, updated_at)
    if current is None:
        return new
    closed = current.where(F.col("valid_to").isNotNull())
    return closed.unionByName(merge_open(current.where(F.col("valid_to").isNull()), new, key))


def valid_at(history: DataFrame, moment: Column) -> DataFrame:
    """Versions that were open at `moment`."""
    return history.where(
        (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))
    )


class SnapshotTable:
    """History on plain Parquet, in hash buckets of the key that are copied on write.

    A run reads the key and change time of the open rows in the buckets its input falls in, and writes anew only
    the buckets in which something changes: `_part=N-x/_open=true/_bucket=B` with their open rows, and the rows it closes
    beside them. So what a run reads and writes grows with the buckets its input touches, not with the table;
    an input without changes writes no rows at all. Take about as many buckets as the open rows fill files.

    The commit of a version names the part that holds each bucket's open rows and the parts with closed rows. A run that
    dies leaves the version before in force. Of two runs at a time one commits, the other merges again on top of it.
    With `keep`, only the last `keep` versions can still be read as of then; parts that only older ones need are removed.
    """

    BUCKETS = 16

    def __init__(self, spark: SparkSession, path: str, keep: int | None = None, buckets: int = BUCKETS):
        if keep is not None and keep < 1:
            raise ValueError("at least one version must be kept")
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep = keep
        self.buckets = buckets  # of a new table; a stored one knows its own
        self.log = CommitLog(spark, self.path)

    def version(self) -> int:
        """Last committed version, 0 when there is none."""
        return self.log.version()

    def _state(self, version: int) -> dict:
        return self.log.entry(version) if version else {"buckets": self.buckets, "open": {}, "closed": [], "schema": None}

    def _open_dirs(self, state: dict, buckets: list[int] | None = None) -> list[str]:
        chosen = state["open"] if buckets is None else {str(b) for b in buckets} & set(state["open"])
        return sorted(f"{self.path}/_part={state['open'][b]}/_open=true/_bucket={b}" for b in chosen)

    def _rows(self, state: dict, dirs: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        if not dirs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*dirs).select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The history as of a version, default the last one."""
        last = self.version()
        at = last if version is None else version
        if not 0 < at <= last:
            raise FileNotFoundError(f"no version {at} of {self.path}")
        if self.keep is not None and at <= last - self.keep:
            raise ValueError(f"version {at} is older than the {self.keep} kept")
        state = self._state(at)
        closed = [f"{self.path}/_part={part}/_open=false" for part in state["closed"]]
        return self._rows(state, self._open_dirs(state) + closed)

    def apply(self, incoming: DataFrame, key: str, updated_at: str, attempts: int = 20) -> int:
        """Merge one input into the next version and return its number. Its columns must be those of the first one."""
        new, key = _newest_versions(incoming, key, updated_at)
        rows: DataFrame | None = None
        for _ in range(attempts):
            version = self.version() + 1
            state = self._state(version - 1)
            schema = T.StructType.fromJson(state["schema"]) if state["schema"] else new.schema
            if set(schema.names) != set(new.columns):
                raise ValueError(f"columns of {self.path} are {schema.names}, not {new.columns}")
            state = {**state, "schema": schema.jsonValue()}
            bucket = F.pmod(F.xxhash64(key), F.lit(state["buckets"])).cast("int")
            if rows is None:
                rows = store(new.select(*schema.names, bucket.alias("_bucket")), "history_input")
            state = self._merged(state, rows, key, bucket, version)
            try:
                self.log.commit(version, state)
            except Conflict:
                continue
            self._remove_old(version)
            return version
        raise Conflict(f"{self.path}: lost {attempts} races")

    def _merged(self, state: dict, rows: DataFrame, key: str, bucket: Column, version: int) -> dict:
        """Write what the input changes and return the new state."""
        names = T.StructType.fromJson(state["schema"]).names
        known = self._rows(state, self._open_dirs(state, _buckets(rows))).select(
            F.col(key).alias("_key"), F.col("updated_at").alias("_since"), F.lit(True).alias("_known")
        )
        changes = store(
            rows.join(known, F.col(key).eqNullSafe(F.col("_key")), "left")
            .where(F.col("_known").isNull() | (F.col("updated_at") > F.col("_since")))
            .select(*names, "_bucket"),
            "history_changes",
        )
        touched = _buckets(changes)
        if not touched:
            return state
        part = f"{version}-{uuid.uuid4().hex[:12]}"
        merged = merge_open(self._rows(state, self._open_dirs(state, touched)), changes.select(*names), key)
        (
            merged.withColumns({"_open": F.col("valid_to").isNull(), "_bucket": bucket})
            .repartition("_bucket")
            .write.partitionBy("_open", "_bucket").parquet(f"{self.path}/_part={part}")
        )
        closes = path_exists(self.spark, f"{self.path}/_part={part}/_open=false")
        return {
            **state,
            "open": {**state["open"], **{str(b): part for b in touched}},
            "closed": state["closed"] + [part] * closes,
        }

    def _remove_old(self, version: int) -> None:
        """Remove the open rows that only versions no longer kept refer to; a run that died before this is made up for."""
        if self.keep is None or version <= self.keep:
            return
        last_gone = version - self.keep
        kept = {d for _, state in self.log.entries(last_gone, version) for d in self._open_dirs(state)}
        for _, state in self.log.entries(max(0, last_gone - 8), last_gone):
            for path in set(self._open_dirs(state)) - kept:
                remove(self.spark, path)


def _buckets(rows: DataFrame) -> list[int]:
    """Buckets that occur; there are not more than the table has."""
    return [r[0] for r in rows.select("_bucket").distinct().collect()]
