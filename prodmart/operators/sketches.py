"""Column profiles that merge: counts, distinct values and quantiles from sketches kept per part of a table.

A sketch of a part is a few kilobytes whatever the part holds. Merging the parts' sketches gives the profile of the whole
without reading a row again: counts are exact, distinct counts (HyperLogLog) and quantiles (KLL) within the error of one
sketch over everything. All of it is Spark's own aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import nan_to_null
from .profile import QUARTILES, numeric_columns

LOG_BUCKETS = 14
KLL_SIZE = 800
# Bounds the estimates are held to: three standard errors of the distinct count, and the rank error of a quantile.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_BUCKETS / 2)
RANK_ERROR = 0.005


def sketch_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column, in one scan: `n_rows`, `n_known`, and the sketches `distinct` and `spread` (numbers only).

    NaN is an unknown number. Maps and other types without a text form are left out by default.
    """
    names = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")] if columns is None else columns
    numbers = set(numeric_columns(df))
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(names):
        col = F.col(f"`{name}`")
        if name in numbers:
            value = nan_to_null(col.cast("double"))
            known = F.when(value.isNotNull(), col)
            aggs.append(F.kll_sketch_agg_double(value, KLL_SIZE).alias(f"s{i}"))
        else:
            known = col
        aggs += [F.count(known).alias(f"c{i}"), F.hll_sketch_agg(known.cast("string"), LOG_BUCKETS).alias(f"d{i}")]
    entries = [
        F.struct(
            F.lit(name).alias("column"), F.col("n").alias("n_rows"), F.col(f"c{i}").alias("n_known"),
            F.col(f"d{i}").alias("distinct"),
            (F.col(f"s{i}") if name in numbers else F.lit(None).cast("binary")).alias("spread"),
        )
        for i, name in enumerate(names)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def merge_sketches(parts: DataFrame) -> DataFrame:
    """The rows of several parts' sketches as those of their union."""
    return parts.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_known").alias("n_known"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.when(F.count("spread") > 0, F.kll_merge_agg_double("spread")).alias("spread"),
    )


def estimates(sketches: DataFrame, points: list[float] | None = None) -> DataFrame:
    """`n_rows`, `n_known`, `n_distinct` and quantiles `q0`, `q1`, ... of every column; NULL where no number is known."""
    has_numbers = F.col("spread").isNotNull() & (F.col("n_known") > 0)

    def quantile(point: float) -> Column:
        return F.when(has_numbers, F.kll_sketch_get_quantile_double("spread", F.lit(float(point))))

    return sketches.select(
        "column", "n_rows", "n_known", F.hll_sketch_estimate("distinct").alias("n_distinct"),
        *[quantile(p).alias(f"q{i}") for i, p in enumerate(QUARTILES if points is None else points)],
    )
