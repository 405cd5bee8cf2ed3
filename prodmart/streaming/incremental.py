"""Incremental page ingest: every run takes the files that landed since the last one."""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import flag_rows, load_rules
from ..plans.clean import clean_products
from ..plans.load import KEYS, load_raw
from ..schema import ORDER_COLUMNS
from ..sources.landing import PAGE_OPTIONS, PAGE_SCHEMA, bad_pages, page_rows
from ..sources.tables import Lakehouse
from .first_seen import first_seen, with_new_keys


def ingest_pages(
    spark: SparkSession,
    landing: str,
    lake: Lakehouse,
    checkpoint: str,
    name: str,
    as_of: datetime | Column | None = None,
    files_per_batch: int = 50_000,
) -> StreamingQuery:
    """Start one pass over the new files of a landing directory (`availableNow`).

    A micro-batch of at most `files_per_batch` files is parsed once, cleaned and appended like a daily
    load, unreadable pages beside it. Its batch id is made of `name` and the batch number, so a batch repeated after a failure
    replaces itself; give each checkpoint its own `name`.
    """

    def load(batch: DataFrame, number: int) -> None:
        batch_id = batch_name(name, number)
        stamp = F.current_timestamp() if as_of is None else as_of
        # Two outputs; a block lost with its executor is parsed again.
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            load_raw(lake, clean_products(page_rows(batch), batch_id, stamp), batch_id, bad_pages(batch))
        finally:
            batch.unpersist()

    pages = landed_pages(spark, landing, files_per_batch).select("products", "_corrupt_record", "_metadata")
    return one_pass(pages, load, checkpoint)


def ingest_new_keys(
    spark: SparkSession,
    landing: str,
    lake: Lakehouse,
    checkpoint: str,
    name: str,
    as_of: datetime | Column | None = None,
    files_per_batch: int = 50_000,
) -> StreamingQuery:
    """Like `ingest_pages`, for feeds that mostly repeat what landed before: known keys end in the stream's state.

    Rows are cleaned and validated in the stream, and only the first good row of each new key goes on to the load, whose
    look-up in the stored table then is as small as the news: few keys become a filter on its Bloom filters. That look-up
    still decides, so a key of another load never enters twice. Rejected rows and unreadable pages are set aside as before;
    repetitions of known keys are neither staged nor counted. Pages are parsed three times: for the rows, for their keys and
    for those that cannot be read. `with_new_keys` says how large the state gets.
    """
    stamp = F.lit(None) if as_of is None else as_of  # the load fills it in
    pages = landed_pages(spark, landing, files_per_batch)
    rows = clean_products(page_rows(pages), name, stamp)
    rows = flag_rows(rows, load_rules(rows.columns))
    rows = with_new_keys(rows, F.col(KEYS[0]), F.col("reject_reason").isNotNull())
    broken = bad_pages(pages).select(F.col("file_path").alias("_path"), F.col("body").alias("_body"))
    unread = F.col("_path").isNotNull()
    news = rows.unionByName(broken, allowMissingColumns=True)

    def load(batch: DataFrame, number: int) -> None:
        # Reading the state again would be a second update of it.
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            read = batch.where(~unread).drop("_path", "_body")
            aside = batch.where(unread).select(F.col("_path").alias("file_path"), F.col("_body").alias("body"))
            load_raw(lake, first_seen(read, ORDER_COLUMNS).drop("reject_reason"), batch_name(name, number), aside)
        finally:
            batch.unpersist()

    return one_pass(news, load, checkpoint)


def landed_pages(spark: SparkSession, landing: str, files_per_batch: int) -> DataFrame:
    reader = spark.readStream.schema(PAGE_SCHEMA).options(**PAGE_OPTIONS)
    return reader.option("maxFilesPerTrigger", files_per_batch).json(landing)


def batch_name(name: str, number: int) -> str:
    return f"{name}_{number:08d}"


def one_pass(rows: DataFrame, load, checkpoint: str) -> StreamingQuery:  # noqa: ANN001
    return (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
