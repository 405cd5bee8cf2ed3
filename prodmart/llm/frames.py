"""Frames with safe inner names, written intermediates, per-batch steps and label samples."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share: `spark.checkpoint.dir`, or where that is unset the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_work"
    return folder.rstrip("/")


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write an intermediate below the shared folder, in directories of the columns `by`, and return the written table;
    its lineage ends there."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, whatever path the driver found it on."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "prodmart_llm.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                archive.write(os.path.join(here, name), f"prodmart/llm/{name}")
        archive.write(os.path.join(os.path.dirname(here), "__init__.py"), "prodmart/__init__.py")
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """`mapInArrow` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


class Inner:
    """A frame whose columns are renamed, so that an operator's own columns cannot clash with any of them."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.kept = [f"_in{i}" for i in range(len(self.names))]
        self.df = df.toDF(*self.kept)

    def __getitem__(self, name: str) -> str:
        """Inner name of a column; the first of several with one name."""
        return self.kept[self.names.index(name)]

    def text(self, name: str = "text") -> Column:
        return F.col(self[name]).cast("string")

    def outer(self, df: DataFrame) -> DataFrame:
        """The input's columns under their own names."""
        return df.select(*self.kept).toDF(*self.names)

    def with_results(self, df: DataFrame, results: list[str]) -> DataFrame:
        """The input's columns and the operator's; a result replaces an input column of its name."""
        keep = [k for k, n in zip(self.kept, self.names) if n not in results]
        names = [n for n in self.names if n not in results]
        return df.select(*keep, *results).toDF(*names, *results)


def add_columns(
    df: DataFrame, text: str, fields: list[T.StructField], step: Callable[[pa.Array], list[pa.Array]]
) -> DataFrame:
    """Append columns that `step` makes from the text column of each Arrow batch; the rest passes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = step(batch.column(batch.schema.names.index(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *(f.name for f in fields)])

    return map_batches(df, run, T.StructType([*df.schema.fields, *fields]))


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, mod 5, is 0. A null id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def training_texts(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, text: str = "text"
) -> list[tuple[str, int]]:
    """About `rows` labelled texts, the same ones on every run, for fitting a model.

    The sample is the labelled ids that are not held out whose hash lies below a share of its range, so no
    task sorts or gathers candidates. An id labelled twice counts as 1 when any of its labels is. Of rows
    that repeat an id, the one whose text has the least hash is used: the bound holds for rows, and the others are
    reduced on Spark, in every task before its rows meet.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    )
    total = known.count()
    if not total:
        return []
    share = min(1.0, rows / total)
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id")  # about `rows` ids; rows of a common id stay where they are
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"]
    table = found.groupBy("doc_id", "label").agg(first.alias("text")).toArrow()
    order = sorted(range(table.num_rows), key=lambda i: (table["doc_id"][i].as_py(), table["text"][i].as_py()))
    return [(table["text"][i].as_py(), table["label"][i].as_py()) for i in order]
