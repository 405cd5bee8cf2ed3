"""Global order without a single-partition window: dense ids, running totals, exact quantiles.

A window without partition keys moves everything into one task. Here the rows are cut into
value ranges; only the per-range totals (at most `ranges` rows) meet in one place.

The cut points are one row per hash bucket, the one with the smallest hash: a uniform sample that
depends on the data alone and is reduced before the shuffle, so that no task meets more than one row
per bucket and input task. The cut points steer balance and never the result, and a recomputed task
(lost executor) sees the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

RANGES = 1024


def range_count(spark: SparkSession) -> int:
    """Ranges for a job: a power of two, 1024 or as many as the session has shuffle partitions."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(RANGES, 1 << (partitions - 1).bit_length())


def _sort_key(order: list[str]) -> str:
    """Comparable struct that sorts NULL last in every column."""
    return "struct(" + ", ".join(f"`{name}` IS NULL, `{name}`" for name in order) + ")"


def nulls_last(order: list[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in order]


def with_ranges(
    df: DataFrame, order: list[str], sampled: DataFrame | None = None, ranges: int | None = None
) -> DataFrame:
    """Add `_range`, a number in 0 .. ranges - 1 (a power of two, default `range_count`) that grows with `order`.

    `sampled` is where the cut points come from, default `df`.
    """
    key = _sort_key(order)
    ranges = ranges or range_count(df.sparkSession)
    cuts = (
        (df if sampled is None else sampled)
        .select(F.expr(key).alias("k"))
        .groupBy(F.pmod(F.xxhash64("k"), F.lit(ranges - 1)).alias("bucket"))
        .agg(F.min(F.struct(F.xxhash64("k").alias("h"), "k"))["k"].alias("k"))
        .agg(F.array_sort(F.collect_list("k")).alias("cuts"))
        .scalar()
    )
    # Binary search for the number of cuts at or below the key. Every halving refers to the column
    # before it, so the search compiles to plain code; it is never NULL, so that the join on it adds
    # no IS NOT NULL filter to the scans.
    search = ["0 AS _at0"]
    for i in range(1, ranges.bit_length()):
        at, step = f"_at{i - 1}", ranges >> i
        search.append(f"{at} + CASE WHEN get(_cuts, {at} + {step - 1}) <= {key} THEN {step} ELSE 0 END AS _at{i}")
    found = F.col(f"_at{len(search) - 1}").alias("_range")
    return df.select("*", cuts.alias("_cuts")).selectExpr("*", *search).select(*df.columns, found)


def running_total(df: DataFrame, order: list[str], weight: Column, out: str, ranges: int | None = None) -> DataFrame:
    """Add the running sum of the positive `weight` over the global order; `order` must identify the rows."""
    weighted = df.withColumn("_weight", weight.cast("bigint"))
    # Looking at the weight keeps the sampled plan equal to `df`, so that its shuffle is reused.
    ranged = with_ranges(weighted, order, weighted.where("_weight > 0"), ranges)
    totals = ranged.groupBy("_range").agg(F.sum("_weight").alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = (
        Window.partitionBy("_range").orderBy(*nulls_last(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # at most `ranges` rows are broadcast
    return ranged.join(F.broadcast(offsets), "_range", "left").select(
        *df.columns, (F.sum("_weight").over(inside) + F.col("_offset")).alias(out)
    )


def dense_ids(df: DataFrame, order: list[str], out: str, ranges: int | None = None) -> DataFrame:
    """Consecutive ids 1..n in the order of `order` (NULL last), which must identify the rows."""
    return running_total(df, order, F.lit(1), out, ranges).select(out, *df.columns)


def exact_quantiles(long: DataFrame, group: str, value: str, points: list[float], ranges: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles of `value` per `group`, one column `q0, q1, ...` per point.

    One row per group is joined back; Spark broadcasts them when their size allows. Values are counted
    first, so repeated ones shuffle once, and neither a group nor the list of groups is gathered in one task. NULL is a
    group like any other.
    """
    counted = long.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(counted, [group, value], F.col("_n"), "_upto", ranges)
    sizes = counted.groupBy(group).agg(F.sum("_n").alias("_size"))
    starts = running_total(sizes, [group], F.col("_size"), "_end", ranges).select(
        F.col(group).alias("_group"), "_size", (F.col("_end") - F.col("_size")).alias("_start")
    )
    rows = ranked.join(starts, F.col(group).eqNullSafe(F.col("_group"))).withColumn("_rank", F.col("_upto") - F.col("_start"))

    lows, highs = [], []
    for i, point in enumerate(points):
        target = (F.col("_size") - 1) * F.lit(float(point))
        lows.append(F.min(F.when(F.col("_rank") > F.floor(target), F.col(value))).alias(f"_lo{i}"))
        highs.append(F.min(F.when(F.col("_rank") > F.ceil(target), F.col(value))).alias(f"_hi{i}"))
    picked = rows.groupBy(group, "_size").agg(*lows, *highs)
    result = []
    for i, point in enumerate(points):
        target = (F.col("_size") - 1) * F.lit(float(point))
        part = target - F.floor(target)
        result.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * part).alias(f"q{i}"))
    return picked.select(group, *result)
