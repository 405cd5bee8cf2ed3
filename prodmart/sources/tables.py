"""Parquet tables under layer namespaces, the audit log, and plain-file output."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, types as T

# Layer names.
LAYERS = ["raw", "staging", "marts", "audit", "snapshots"]

COMMITTED = "_COMMITTED"
# Rows of a file. Repeating rows shrink so much in Parquet that a file cut by bytes alone would hand a task more of them
# than fit its memory when they are sorted.
ROWS_PER_FILE = 50_000

AUDIT_SCHEMA = T.StructType(
    [T.StructField("model_name", T.StringType()), T.StructField("run_at", T.TimestampType())]
)


def layer_name(custom: str | None, default: str = "staging") -> str:
    """A custom layer name is used verbatim (trimmed), never prefixed with the default."""
    return default if custom is None else custom.strip()


class Lakehouse:
    """Path layout `<root>/<layer>/<table>` on any file system Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str | None, table: str) -> str:
        return f"{self.root}/{layer_name(layer)}/{table}"

    def read(self, layer: str | None, table: str, schema: T.StructType | None = None) -> DataFrame:
        """Table scan; with a `schema`, a table nobody wrote yet reads as empty."""
        path = self.path(layer, table)
        if schema is None:
            return self.spark.read.parquet(path)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def refresh(
        self,
        df: DataFrame,
        layer: str | None,
        table: str,
        keep: int = 2,
        check: Callable[[DataFrame], None] | None = None,
    ) -> DataFrame:
        """Full refresh; returns the written table.

        Each refresh is a new `build=N` directory that counts once it is written and `check`, called with
        the written rows, did not raise. Readers of the build before stay undisturbed, and a refresh that dies or
        fails its check leaves the table as it was. Counted builds older than the last `keep` are removed.
        """
        path = self.path(layer, table)
        done = committed(self.spark, path, "build")
        number = max(done, default=0) + 1
        write_table(df, f"{path}/build={number}")
        if check is not None:
            check(self.spark.read.parquet(f"{path}/build={number}"))
        commit(self.spark, f"{path}/build={number}")
        for old in done[: max(len(done) + 1 - keep, 0)]:
            remove(self.spark, f"{path}/build={old}")
        return self.latest(layer, table)

    def latest(self, layer: str | None, table: str) -> DataFrame:
        """The last committed refresh of a table."""
        path = self.path(layer, table)
        done = committed(self.spark, path, "build")
        if not done:
            raise FileNotFoundError(f"no committed build of {path}")
        return self.spark.read.parquet(f"{path}/build={done[-1]}")

    def view(self, df: DataFrame, name: str) -> DataFrame:
        """View materialisation: nothing is stored."""
        df.createOrReplaceTempView(name)
        return df

    def log_model_run(self, model: str, run_at: datetime) -> None:
        log_model_run(self.spark, model, run_at, self.path("audit", "model_runs"))


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Any file system; object stores included."""
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path names one directory; a pattern of several does not."""
    target, fs = _file_system(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def open_file(spark: SparkSession, path: str):
    """Input stream of a file on any file system."""
    target, fs = _file_system(spark, path)
    return fs.open(target)


def plain_path(path: str) -> str:
    """A file's path as a reader takes it: characters of path patterns stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def remove(spark: SparkSession, path: str) -> None:
    target, fs = _file_system(spark, path)
    fs.delete(target, True)


def commit(spark: SparkSession, path: str) -> None:
    """Declare a written directory valid. The marker is our own: Spark's `_SUCCESS` can be turned off."""
    target, fs = _file_system(spark, f"{path}/{COMMITTED}")
    fs.create(target, True).close()


def committed(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers N of the directories `<path>/<prefix>=N` that were committed, ascending."""
    target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(
        int(name.split("=", 1)[1])
        for name in names
        if name.startswith(f"{prefix}=") and path_exists(spark, f"{path}/{name}/{COMMITTED}")
    )


def write_table(df: DataFrame, path: str, mode: str = "overwrite", index: str | None = None) -> None:
    """Parquet write of a whole directory.

    With `index`, a column, every row group carries a Bloom filter of its values, of a size that fits them, and files are
    sorted by it: a scan for some values then skips the row groups that hold none of them. Without, a file gets at most
    `ROWS_PER_FILE` rows, for jobs that read whole tables back.
    """
    writer = (df if index is None else df.sortWithinPartitions(index)).write.mode(mode)
    if index is None:
        writer = writer.option("maxRecordsPerFile", ROWS_PER_FILE)
    else:
        writer = writer.option(f"parquet.bloom.filter.enabled#{index}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: str) -> None:
    """Write one batch of a table partitioned by `batch_id`, replacing that batch only.

    The batch goes straight into its directory: no sort by partition value, and no other batch is
    touched when a run is repeated.
    """
    if not re.fullmatch(r"[\w.-]+", batch_id):
        raise ValueError(f"batch id is not a plain name: {batch_id}")
    write_table(df.drop("batch_id"), f"{path}/batch_id={batch_id}")


def work_dir(spark: SparkSession) -> str:
    """The folder driver and executors share: `spark.checkpoint.dir`, or where that is unset the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_work"
    return folder.rstrip("/")


_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the work folder, or below that of the job in a `scratch_folder`."""
    return f"{_job_folder.get() or work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate that several consumers read, and return the written table.

    Unlike a cache it survives lost executors, and its readers prune columns and push filters.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A work folder of one job: intermediates that `store` makes inside go below it and are removed at the end.

    Results that read them have to be written before.
    """
    folder = scratch_path(spark, "job")
    token = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(token)
        remove(spark, folder)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str, mode: str = "append") -> None:
    """Catalog table bucketed and sorted by `keys`, so joins on them need no shuffle of this side."""
    df.write.mode(mode).option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int | None = None) -> None:
    """CSV output that `read_extract_csv` reads back unchanged: quotes doubled, line breaks and outer blanks kept.

    A file with line breaks in its texts is read by one task, so a file gets at most `rows_per_file` rows,
    default `ROWS_PER_FILE`.
    """
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file or ROWS_PER_FILE).csv(
        path, header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def init_audit(spark: SparkSession, path: str) -> None:
    """Create the empty audit log unless it exists."""
    if not path_exists(spark, path):
        spark.createDataFrame([], AUDIT_SCHEMA).write.mode("ignore").parquet(path)


def audit_row(spark: SparkSession, model: str, run_at: datetime) -> DataFrame:
    return spark.createDataFrame([(model, run_at)], AUDIT_SCHEMA)


def log_model_run(spark: SparkSession, model: str, run_at: datetime, path: str) -> None:
    """Append one row to the audit log."""
    audit_row(spark, model, run_at).coalesce(1).write.mode("append").parquet(path)


def read_model_runs(spark: SparkSession, path: str) -> DataFrame:
    init_audit(spark, path)
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)
