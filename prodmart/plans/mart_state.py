"""Marts kept up to date batch by batch, from a table of exact sums.

A mart of averages follows from one row per group: how many products, and of each nutrient how many known values and
their sum. Sums are decimals of `SCALE` digits after the point, so they add up to the same whatever the order of rows and batches,
and rows can be taken off again. `advance` reads only the batches that became valid since the state's version, or were
replaced, and merges their sums with the stored ones: work grows with the new rows and the number of groups.

Averages come from exact sums, rounded half away from zero. A build from scratch (`marts`) averages doubles, which may round
an average that ends exactly in a tie either way. Values beyond 16 digits before the point count as unknown.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import explode_tags
from ..schema import NUTRIENT_COLUMNS
from ..sources.commits import CommitLog, Conflict
from ..sources.tables import Lakehouse, remove, write_table
from .load import RAW_SCHEMA, RawLog
from .marts import AVERAGES, MIN_PRODUCTS
from .staging import stg_products

SCALE = 12
EXACT = T.DecimalType(28, SCALE)
SUM = T.DecimalType(38, SCALE)
STATE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("total_products", T.LongType()),
    *(T.StructField(f"n_{c}", T.LongType()) for c in AVERAGES), *(T.StructField(f"s_{c}", SUM) for c in AVERAGES),
])


@dataclass(frozen=True)
class Mart:
    """`rows` gives (name, nutrients) of staged products, one row per product and group."""

    rows: Callable[[DataFrame], DataFrame]
    out: str
    min_products: int = 1


def _by_group(stg: DataFrame) -> DataFrame:
    return stg.where(F.col("pnns_groups_1").isNotNull()).select(F.col("pnns_groups_1").alias("name"), *NUTRIENT_COLUMNS)


def _by_brand(stg: DataFrame) -> DataFrame:
    tags = explode_tags(stg, ["code", *NUTRIENT_COLUMNS], "brands_tags", "brand_name")
    return tags.select(F.upper("brand_name").alias("name"), *NUTRIENT_COLUMNS)


MARTS = {
    "mart_nutrient_profile": Mart(_by_group, "pnns_groups_1"),
    "mart_brand_quality": Mart(_by_brand, "brand_name", MIN_PRODUCTS),
}


def sums(rows: DataFrame, sign: int = 1) -> DataFrame:
    """State of some rows; with sign -1 what takes them off a state."""

    def exact(name: str) -> Column:
        return F.when(~F.isnan(name), F.col(name)).try_cast(EXACT)

    return rows.groupBy("name").agg(
        (F.count(F.lit(1)) * sign).alias("total_products"),
        *((F.count(exact(c)) * sign).alias(f"n_{c}") for c in AVERAGES),
        *((F.coalesce(F.sum(exact(c)), F.lit(0)) * F.lit(sign).cast("decimal(1,0)")).cast(SUM).alias(f"s_{c}") for c in AVERAGES),
    )


def merge(states: list[DataFrame]) -> DataFrame:
    """One state of several; a group without rows left is gone."""
    together = reduce(DataFrame.unionByName, states)
    added = together.groupBy("name").agg(
        *(F.sum(f.name).cast(f.dataType).alias(f.name) for f in STATE_SCHEMA.fields if f.name != "name")
    )
    return added.where("total_products != 0")


def averages(state: DataFrame, out: str, min_products: int = 1) -> DataFrame:
    """The mart of a state."""
    rounded = [F.round(F.try_divide(f"s_{c}", F.col(f"n_{c}")), 2).cast("double").alias(a) for c, a in AVERAGES.items()]
    return state.where(F.col("total_products") >= min_products).select(F.col("name").alias(out), "total_products", *rounded)


class MartState:
    """The stored state of one mart over the raw layer of a lake."""

    def __init__(self, lake: Lakehouse, name: str):
        self.lake, self.mart = lake, MARTS[name]
        self.path = lake.path("marts", f"state_{name}")
        self.raw = RawLog(lake)
        self.log = CommitLog(lake.spark, self.path)

    def _stored(self, entry: dict | None) -> DataFrame:
        if not entry:
            return self.lake.spark.createDataFrame([], STATE_SCHEMA)
        return self.lake.spark.read.schema(STATE_SCHEMA).parquet(f"{self.path}/part={entry['part']}")

    def state(self) -> DataFrame:
        return self._stored(self.log.entry(self.log.version()) if self.log.version() else None)

    def read(self) -> DataFrame:
        """The mart as of the last `advance`."""
        return averages(self.state(), self.mart.out, self.mart.min_products)

    def advance(self, attempts: int = 20) -> int:
        """Take in what the raw layer got since; returns the raw version the state now stands at."""
        for _ in range(attempts):
            version = self.log.version()
            entry = self.log.entry(version) if version else None
            at, batches = self.raw.state()
            before = self.raw.state(entry["raw"])[1] if entry else {}
            fresh = {b: t for b, t in batches.items() if before.get(b) != t}
            gone = {b: t for b, t in before.items() if batches.get(b) != t}
            if entry and at == entry["raw"]:
                return at
            states = [self._stored(entry)]
            for sign, tries in ((1, fresh), (-1, gone)):
                if tries:
                    rows = stg_products(self.raw.rows("products", RAW_SCHEMA, tries))
                    states.append(sums(self.mart.rows(rows), sign))
            part = f"{version + 1}-{uuid.uuid4().hex[:12]}"
            write_table(merge(states), f"{self.path}/part={part}", mode="errorifexists")
            try:
                self.log.commit(version + 1, {"part": part, "raw": at})
            except Conflict:
                continue
            for _, old in self.log.entries(max(0, version - 8), version - 1):  # readers of the version before go on
                remove(self.lake.spark, f"{self.path}/part={old['part']}")
            return at
        raise Conflict(f"{self.path}: lost {attempts} races")
