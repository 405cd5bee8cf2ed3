"""Readers for landed pages (one JSON object with a `products` array per file) and CSV extracts."""

from __future__ import annotations

import csv
import io
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.numbers import parse_double, parse_long
from ..schema import COLUMNS, ORDER_COLUMNS, conform, field_type, struct_of
from .tables import is_folder, open_file, plain_path

CORRUPT = "_corrupt_record"
HEADER_BYTES = 1 << 16

# List- and dict-valued fields are read as text too: the JSON reader hands over their JSON
# notation, which the tag and literal functions accept like the Python notation.
RECORD_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in COLUMNS])
PAGE_SCHEMA = T.StructType(
    [
        T.StructField("products", T.ArrayType(RECORD_SCHEMA)),
        T.StructField(CORRUPT, T.StringType()),
    ]
)
# Texts a dataframe library's CSV reader takes for a missing value; pass as `na_values`
# to read a feed the way a CSV hop through such a library would.
NA_VALUES = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
# A file is one record, as nothing holds this separator. A page that is taken in as one text has its numbers and objects
# copied from memory; read with `multiLine`, Spark opens the file again for every value that is not a JSON string.
END_OF_PAGE = "\0end of page 8f1c6b52-3d0e-4c55-9a7e-6f0d2b9c41aa\0"
PAGE_OPTIONS = {"lineSep": END_OF_PAGE, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def typed(name: str, col: Column) -> Column:
    kind = field_type(name)
    if isinstance(kind, T.DoubleType):
        return parse_double(col)
    if isinstance(kind, T.LongType):
        return parse_long(col)
    return col


def known_text(col: Column, na_values: list[str] | None = None) -> Column:
    """Text, or NULL when it is empty or stands for a missing value."""
    return F.when(~col.isin(["", *(na_values or [])]), col)


def reading_key(path: Column) -> Column:
    """Text that sorts paths the way people do: folder by folder, `page_2` before `page_10`.

    Runs of digits are padded to 20 places. The path itself follows, so that no two files share a key.
    Names decide rather than modification times, which change when a folder is copied.
    """
    padded = F.regexp_replace(path, r"(\d+)", "0" * 20 + "$1")
    return F.concat_ws(" ", F.regexp_replace(padded, r"\d*(\d{20})", "$1"), path)


def page_number(file_name: Column) -> Column:
    """The digits after `page` in a file name, else its last digits, else NULL."""
    named = F.regexp_extract(file_name, r"(?i)page\D?(\d+)", 1).try_cast("bigint")
    return F.coalesce(named, F.regexp_extract(file_name, r"(\d+)(?=\D*$)", 1).try_cast("bigint"))


def page_rows(pages: DataFrame, na_values: list[str] | None = None) -> DataFrame:
    """One typed row per record, with its place in the reading order: file, page number, position.

    A page without `products` yields no rows. Empty text is NULL, as it is in a CSV extract.
    """
    return pages.select(
        reading_key(F.col("_metadata.file_path")).alias("source_file"),
        page_number(F.col("_metadata.file_name")).alias("page_no"),
        F.posexplode("products").alias("pos", "product"),
    ).select(
        "source_file",
        "page_no",
        F.col("pos").cast("bigint").alias("pos"),
        *[typed(c, known_text(F.col(f"product.{c}"), na_values)).alias(c) for c in COLUMNS],
    )


def bad_pages(pages: DataFrame) -> DataFrame:
    """Unreadable pages with their text, for quarantine."""
    # The reader refuses to return the corrupt text alone, so the filter looks at the data as well.
    broken = F.col(CORRUPT).isNotNull() & (F.coalesce(F.size("products"), F.lit(0)) >= 0)
    return pages.where(broken).select(F.col("_metadata.file_path").alias("file_path"), F.col(CORRUPT).alias("body"))


def page_fields(spark: SparkSession, path: str) -> DataFrame:
    """Every field name in the landed pages and the number of records carrying it."""
    anything = f"products array<map<string,string>>, {CORRUPT} string"
    return (
        spark.read.schema(anything).options(**PAGE_OPTIONS).json(path)
        .select(F.explode("products").alias("product"))
        .select(F.explode(F.map_keys("product")).alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def read_pages(
    spark: SparkSession, path: str, strict: bool = False, na_values: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """`(rows, quarantine)` of a landing directory; a broken page never stops the others.

    `strict` raises when no record at all carries a kept field (otherwise it is NULL). `na_values` are
    texts that mean NULL besides the empty one.
    """
    if strict:
        found = page_fields(spark, path).where(F.col("field").isin(COLUMNS)).select("field")
        seen = {row.field for row in found.collect()}  # at most the kept names
        missing = [c for c in COLUMNS if c not in seen]
        if missing:
            raise ValueError(f"pages lack fields: {', '.join(missing)}")
    pages = spark.read.schema(PAGE_SCHEMA).options(**PAGE_OPTIONS).json(path)
    return page_rows(pages, na_values), bad_pages(pages)


def _first_record(spark: SparkSession, path: str) -> list[str]:
    """Names in the header of a CSV file; only its beginning is read."""
    source = open_file(spark, path)
    try:
        head = b""
        while True:
            more = bytes(source.readNBytes(HEADER_BYTES))
            head += more
            text = io.StringIO(head.decode("utf-8-sig", "replace"), newline="")
            record = next(csv.reader(text), [])
            # A header cut short, in a quoted name say, takes all there is.
            if not more or text.read(1):
                return record
    finally:
        source.close()


def header_catalogue(spark: SparkSession, path: str, threads: int = 32) -> dict[tuple[str, ...], list[str]]:
    """The different headers of the CSV files below a path and the files of each.

    The driver opens every file for its first record, many at a time; no data is scanned. It holds what
    it holds for any scan, the list of files.
    """
    files = [unquote(f) for f in spark.read.text(path).inputFiles()]
    with ThreadPoolExecutor(threads) as pool:
        headers = pool.map(lambda f: tuple(_first_record(spark, f)), files)
        groups: dict[tuple[str, ...], list[str]] = {}
        for file, header in zip(files, headers):
            groups.setdefault(header, []).append(file)
    return groups


def read_extract_csv(
    spark: SparkSession,
    path: str,
    na_values: list[str] | None = None,
    strict: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """CSV extracts with headers; columns are matched by name, file by file, and cast without inference.

    Files may differ in the order and number of their columns: those that have the kept columns at the same places are read
    together, by place. A kept column that a file lacks is NULL there, other columns are ignored; of several columns with
    one name the first counts. `strict` raises when any file lacks a kept column. An empty file has no rows.

    `na_values` are texts that mean NULL besides the empty field. `multi_line` is needed for
    line breaks inside quoted text; without them, turn it off so that big files split. The rows carry
    their place in the reading order: file, start of the split, place in the split.
    """
    layouts: dict[tuple[int | None, ...], list[str]] = {}
    for header, files in header_catalogue(spark, path).items():
        places = tuple(header.index(n) if n in header else None for n in COLUMNS)
        if header:
            layouts.setdefault(places, []).extend(files)
    folder = is_folder(spark, path)
    parts = []
    for places, files in layouts.items():
        width = max((p + 1 for p in places if p is not None), default=1)
        fields = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
        reader = spark.read.schema(fields).option("basePath", path) if folder else spark.read.schema(fields)
        raw = reader.csv([plain_path(f) for f in files], header=True, multiLine=multi_line, escape='"', mode="PERMISSIVE")
        found = {n: F.col(f"_c{p}") for n, p in zip(COLUMNS, places) if p is not None}
        found |= {n: F.col(n) for n in COLUMNS if n not in found and n in raw.columns}  # named by a folder `name=value`
        missing = [n for n in COLUMNS if n not in found]
        if strict and missing:
            raise ValueError(f"input lacks columns: {', '.join(missing)}; see {files[0]}")
        values = [typed(n, known_text(c.cast("string"), na_values)).alias(n) for n, c in found.items()]
        # A task reads a split from start to end, so its row numbers grow with the place in the split.
        place = [
            reading_key(F.col("_metadata.file_path")).alias("source_file"),
            F.col("_metadata.file_block_start").alias("page_no"),
            F.monotonically_increasing_id().alias("pos"),
        ]
        parts.append(conform(raw.select(*place, *values), ORDER_COLUMNS + COLUMNS))
    if not parts:
        return spark.createDataFrame([], struct_of(ORDER_COLUMNS + COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def union_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Concatenate frames by column name; a column one of them lacks is NULL there."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
