"""Numeric cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def parse_double(col: Column) -> Column:
    """Finite number or NULL; never raises under ANSI mode."""
    value = col.try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def parse_long(col: Column) -> Column:
    """Integer or NULL; accepts `1600000000.0`, the way a nullable integer column gets written to CSV."""
    return F.coalesce(col.try_cast("bigint"), parse_double(col).try_cast("bigint"))


def clip(col: Column, low: float, high: float) -> Column:
    """Bound a number; NULL and NaN give NULL (plain least/greatest would return a bound)."""
    value = nan_to_null(col)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))
