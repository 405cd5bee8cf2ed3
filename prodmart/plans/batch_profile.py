"""Profile of the raw products from sketches of their batches: a batch is read once, when its profile is first asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.sketches import estimates, merge_sketches, sketch_columns
from ..sources.tables import COMMITTED, Lakehouse, commit, path_exists, write_table
from .load import RAW_SCHEMA, RawLog


class BatchProfiles:
    """Sketches below `audit/batch_profiles`, one directory for each try of a batch.

    A try never changes once it is committed, so neither do its sketches; those of a batch that was replaced are no longer
    looked at. A directory counts with its marker, written last.
    """

    def __init__(self, lake: Lakehouse, columns: list[str] | None = None):
        self.lake, self.columns, self.raw = lake, columns, RawLog(lake)

    def _path(self, name: str) -> str:
        return self.lake.path("audit", f"batch_profiles/try={name}")

    def refresh(self, version: int | None = None) -> list[str]:
        """Make the sketches that are missing at a version of the raw layer; returns the batches that were read."""
        _, batches = self.raw.state(version)
        missing = [b for b, t in sorted(batches.items()) if not path_exists(self.lake.spark, f"{self._path(t['products'])}/{COMMITTED}")]
        for batch in missing:
            rows = self.raw.rows("products", RAW_SCHEMA, {batch: batches[batch]})
            path = self._path(batches[batch]["products"])
            write_table(sketch_columns(rows, self.columns), path)
            commit(self.lake.spark, path)
        return missing

    def read(self, version: int | None = None, points: list[float] | None = None) -> DataFrame:
        """The profile of the raw products at a version."""
        self.refresh(version)
        _, batches = self.raw.state(version)
        if not batches:
            return estimates(sketch_columns(self.lake.spark.createDataFrame([], RAW_SCHEMA), self.columns), points)
        paths = [self._path(t["products"]) for t in batches.values()]
        return estimates(merge_sketches(self.lake.spark.read.parquet(*paths)), points)
