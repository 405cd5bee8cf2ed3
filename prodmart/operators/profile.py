"""Column, map and list profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.literals import parse_array, parse_map
from ..functions.numbers import nan_to_null
from .ranks import exact_quantiles

QUARTILES = [0.25, 0.5, 0.75]


def columns_of_type(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def string_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.StringType)


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.NumericType)


def _unpivot_row(wide: DataFrame, entries: list[Column]) -> DataFrame:
    return wide.select(F.inline(F.array(*entries)))


def profile_columns(df: DataFrame) -> DataFrame:
    """Rows, NULLs, smallest and largest value of every column, in one scan."""
    names = df.columns
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(names):
        col = F.col(f"`{name}`")
        aggs += [F.count(col).alias(f"c{i}"), F.min(col).cast("string").alias(f"lo{i}"),
                 F.max(col).cast("string").alias(f"hi{i}")]
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(df.schema[name].dataType.simpleString()).alias("dtype"),
            F.col("n").alias("n_rows"),
            (F.col("n") - F.col(f"c{i}")).alias("n_null"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
        )
        for i, name in enumerate(names)
    ]
    return _unpivot_row(df.agg(*aggs), entries)


def describe_numeric(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """count, mean, sample standard deviation, min, quartiles and max per numeric column.

    Quartiles interpolate linearly and are exact; `approximate` takes them from a sketch in the
    same scan instead.
    """
    names = numeric_columns(df) if columns is None else columns
    values = df.select(*[nan_to_null(F.col(n).cast("double")).alias(n) for n in names])
    fields = ["count", "mean", "std", "min", "max"]
    aggs, entries = [], []
    for i, name in enumerate(names):
        stats = [F.count(name), F.avg(name), F.stddev_samp(name), F.min(name), F.max(name)]
        if approximate:
            stats += [F.percentile_approx(name, p, 100000) for p in QUARTILES]
        aggs += [stat.alias(f"s{i}_{j}") for j, stat in enumerate(stats)]
        labels = fields + (["q0", "q1", "q2"] if approximate else [])
        entries.append(
            F.struct(F.lit(name).alias("column"), *[F.col(f"s{i}_{j}").alias(label) for j, label in enumerate(labels)])
        )
    table = _unpivot_row(values.agg(*aggs), entries)
    if not approximate:
        pairs = [F.struct(F.lit(n).alias("column"), F.col(n).alias("value")) for n in names]
        long = values.select(F.inline(F.array(*pairs)))
        table = table.join(exact_quantiles(long, "column", "value", QUARTILES), "column", "left")
    return table.select(
        "column", *fields[:4], F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max",
    )


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column in one scan."""
    return profile_columns(df).select("column", "n_null")


def sample_values(df: DataFrame, size: int = 200, columns: list[str] | None = None) -> DataFrame:
    """One non-NULL example per text column, cut to `size` characters; the smallest, so it is reproducible."""
    names = string_columns(df) if columns is None else columns
    wide = df.agg(*[F.substring(F.min(F.col(n)), 1, size).alias(f"s{i}") for i, n in enumerate(names)])
    return _unpivot_row(
        wide, [F.struct(F.lit(n).alias("column"), F.col(f"s{i}").alias("sample")) for i, n in enumerate(names)]
    )


def map_entries(df: DataFrame, col: str) -> DataFrame:
    """One `(key, value)` row per entry of a dict-literal column."""
    return df.where(F.col(col).isNotNull()).select(F.explode(parse_map(F.col(col))))


def map_key_profile(df: DataFrame, col: str) -> DataFrame:
    """Distinct keys with the number of records carrying them."""
    return map_entries(df, col).groupBy("key").agg(F.count(F.lit(1)).alias("n_records"))


def map_value_profile(df: DataFrame, col: str) -> DataFrame:
    """Distinct values with their number of occurrences."""
    return map_entries(df, col).groupBy("value").agg(F.count(F.lit(1)).alias("n_records"))


def list_profile(df: DataFrame, col: str) -> DataFrame:
    """Distinct elements of a list-literal column with their number of occurrences."""
    return (
        df.where(F.col(col).isNotNull())
        .select(F.explode(parse_array(F.col(col))).alias("element"))
        .groupBy("element")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def element_count(df: DataFrame, col: str, approximate: bool = False) -> DataFrame:
    """How many distinct elements a list-literal column has."""
    elements = df.where(F.col(col).isNotNull()).select(F.explode(parse_array(F.col(col))).alias("element"))
    count = F.approx_count_distinct if approximate else F.count_distinct
    return elements.agg(count(F.col("element")).alias("n_elements"))
