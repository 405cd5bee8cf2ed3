"""Surrogate keys that stay: a stored dictionary of members and their numbers.

Ids counted anew in every build (`dense_ids`) shift when a member appears, so whatever kept an old id points elsewhere.
The dictionary gives each member a number once: new members get the numbers after the last one given out, in their own
order, and are appended as a part; known parts are never rewritten. A commit names the parts and the last number, so a run that
dies gives out nothing, and of two runs at a time the later one looks again and goes on behind the other's numbers.

A member is a combination of columns; NULL is a value like any other.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.commits import CommitLog, Conflict
from ..sources.tables import store, write_table
from .ranks import dense_ids


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


class IdDictionary:
    """Ids of the members of one dimension, below `path`."""

    def __init__(self, spark: SparkSession, path: str, out: str):
        self.spark, self.path, self.out = spark, path.rstrip("/"), out
        self.log = CommitLog(spark, self.path)

    def _known(self, entry: dict, schema: T.StructType) -> DataFrame:
        fields = T.StructType([T.StructField(self.out, T.LongType()), *schema.fields])
        if not entry["parts"]:
            return self.spark.createDataFrame([], fields)
        return self.spark.read.schema(fields).parquet(*[f"{self.path}/part={p}" for p in entry["parts"]]).select(*fields.names)

    def assign(self, members: DataFrame, attempts: int = 20) -> DataFrame:
        """The distinct members with their ids; members not seen before get new ones."""
        names = members.columns
        asked = store(members.distinct(), "members")
        for _ in range(attempts):
            version = self.log.version()
            entry = self.log.entry(version) if version else {"parts": [], "top": 0}
            known = self._known(entry, asked.schema)
            fresh = store(asked.join(known, _same(asked, known, names), "left_anti"), "new_members")
            count = fresh.count()
            if count:
                part = f"{version + 1}-{uuid.uuid4().hex[:12]}"
                numbered = dense_ids(fresh, names, self.out).withColumn(self.out, F.col(self.out) + entry["top"])
                write_table(numbered, f"{self.path}/part={part}", mode="errorifexists")
                entry = {"parts": [*entry["parts"], part], "top": entry["top"] + count}
                try:
                    self.log.commit(version + 1, entry)
                except Conflict:
                    continue
            known = self._known(entry, asked.schema)
            return known.join(asked, _same(known, asked, names), "left_semi")
        raise Conflict(f"{self.path}: lost {attempts} races")
