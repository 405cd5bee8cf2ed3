"""Row order for tables that are filtered by several columns: a space-filling curve.

A table sorted by one column can be pruned by that column alone. Here every column is cut into ranges of about as many
distinct values each, and the bits of the range numbers are interleaved (a Z-order curve). Rows near each other on the
curve are near in all columns, so every file and row group spans little of each, and a filter on any of them skips most by their
smallest and largest values. The order changes what a scan reads, never what a query returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ranks import with_ranges

BITS = 6


def curve_position(ranges: list[Column], bits: int) -> Column:
    """Interleave the lowest `bits` bits of the numbers, the first column's highest bit first."""
    total = F.lit(0).cast("bigint")
    width = len(ranges)
    for i, number in enumerate(ranges):
        for bit in range(bits):
            one = F.shiftright(number.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            total = total + F.shiftleft(one, bit * width + (width - 1 - i))
    return total


def clustered(df: DataFrame, columns: list[str], files: int, bits: int = BITS) -> DataFrame:
    """The rows in `files` partitions along the curve over `columns`; write them as they are. NULL comes last in each column.

    The cut points are read from the columns alone; then one shuffle deals the rows out by their place on the curve, and in one
    place by a hash of the row, so that rows that agree in all the columns fill several partitions if there are that many.
    """
    if not 0 < len(columns) * bits <= 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a long")
    names = [f"_range{i}" for i in range(len(columns))]
    found = df
    for column, name in zip(columns, names):
        found = with_ranges(found, [column], df.select(column), 1 << bits).withColumnRenamed("_range", name)
    # A column of few values has few ranges; its numbers are stretched, so that their bits weigh as much as the others'.
    tops = found.agg(*[F.max(n).alias(n) for n in names]).first()
    stretched = [F.floor(F.col(n) * ((1 << bits) / (tops[n] + 1 if tops[n] is not None else 1))) for n in names]
    spread = F.xxhash64(*[f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    placed = found.select(*df.columns, curve_position(stretched, bits).alias("_place"), spread.alias("_spread"))
    dealt = placed.repartitionByRange(files, "_place", "_spread").sortWithinPartitions("_place", *columns)
    return dealt.select(*df.columns)
