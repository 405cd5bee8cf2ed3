"""First row of every key of a stream, with the keys seen so far in the state store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.keyed import first_wins

KEY, FREE, NEW = "_key", "_free", "_new"


def with_new_keys(rows: DataFrame, key: Column, passes: Column) -> DataFrame:
    """The rows of a stream and, for every key that no earlier row had, a row with `_new` that names it.

    Rows where `passes` is true leave no trace. A NULL key is a key like any other.

    State: one entry per key, its text, never the rows; it grows with the distinct keys of the feed and not
    with their repetitions. Entries do not time out: an event-time limit would drop late rows. Spark keeps the state in as
    many partitions as there are shuffle partitions at the first start; for many keys set
    `spark.sql.streaming.stateStore.providerClass` to the RocksDB provider, which holds it on disk.
    """
    known = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))
    marked = rows.withColumns({KEY: known, FREE: F.coalesce(passes, F.lit(False)), NEW: F.lit(False)})
    keys = marked.where(~F.col(FREE)).select(KEY).dropDuplicates([KEY])
    return marked.unionByName(keys.withColumns({FREE: F.lit(False), NEW: F.lit(True)}), allowMissingColumns=True)


def first_seen(batch: DataFrame, order: list[str | Column]) -> DataFrame:
    """Of a micro-batch of `with_new_keys`: the rows that pass, and the first row of each new key by `order`.

    The choice depends on the micro-batch and the state alone, so a micro-batch that runs again after a failure gives the
    same rows. The micro-batch is read more than once here; persist it, as reading the state again would update it again.
    """
    rows = batch.where(~F.col(NEW))
    news = batch.where(F.col(NEW)).select(KEY)
    first = first_wins(rows.where(~F.col(FREE)).join(news, KEY, "left_semi"), [KEY], order)
    return rows.where(F.col(FREE)).unionByName(first).drop(KEY, FREE, NEW)
