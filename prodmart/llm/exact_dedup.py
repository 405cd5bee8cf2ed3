"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after every run of ASCII white space became one space. A first scan
leaves two numbers of each row, the normalised text's length and the hash of its first characters. Lengths that occur
once end there; of the others, (length, prefix hash) pairs that occur once end there. Only rows of the pairs left
over, the surviving groups, have their whole text hashed (SHA-256), in a second scan; everything else is
single by then.

The second scan learns of the surviving groups through a bit map of at most `max_bits` bits, broadcast in words: a
row whose bit is unset is single; a row that shares a bit with a surviving group by chance is hashed in vain and
comes out single from the full hash. So the map's size steers work, never results, and no text is shuffled.

Groups meet by their full hash, reduced in every task first. A group of more than a `HEAVY`th of all rows, of which
there are fewer than `HEAVY`, reaches its rows by broadcast; the others by a join in which no key has more rows than that.

Defined results: a null text is an empty one; a null id is greater than any other; of rows that are equal in
text and id one stays; an empty table gives an empty result; a result column replaces an input column of its name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .frames import Inner, written

PREFIX = 256
HEAVY = 1024
MAX_BITS = 1 << 24
RESULTS = ["keep_id", "group_size", "kept"]


def normalized(text: Column) -> Column:
    """Runs of ASCII white space as one space. A lone space is left alone, so most words need no replacement."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def full_hash(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of a normalised text in UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def bit_words(keys: DataFrame, max_bits: int) -> tuple[DataFrame, int]:
    """Bit map of the column `key` as rows (word, mask), and its number of bits: 16 a key, at most `max_bits`."""
    wanted, bits = min(16 * keys.count(), max_bits), 1 << 10
    while bits < wanted:
        bits *= 2
    at = F.pmod("key", F.lit(bits))
    mask = F.expr(f"shiftleft(1L, CAST(pmod(key, {bits}) & 63 AS INT))")
    words = keys.select(F.shiftright(at, 6).alias("_word"), mask.alias("_mask"))
    return words.groupBy("_word").agg(F.bit_or("_mask").alias("_mask")), bits


def marked(df: DataFrame, key: Column, words: tuple[DataFrame, int], out: str) -> DataFrame:
    """Add `out`: whether the key's bit is set. The words are at most `max_bits` / 64 rows, so they are broadcast."""
    table, bits = words
    probed = df.withColumn("_at", F.pmod(key, F.lit(bits))).withColumn("_word", F.shiftright("_at", 6))
    hit = F.expr("coalesce((shiftrightunsigned(_mask, CAST(_at & 63 AS INT)) & 1L) = 1L, false)")
    return probed.join(F.broadcast(table), "_word", "left").withColumn(out, hit).drop("_at", "_word", "_mask")


def _seen_again(df: DataFrame, keys: list[str], name: str, max_bits: int) -> tuple[DataFrame, int]:
    """Bit map of the values of `keys` that more than one row has. Tasks count their own rows before any shuffle."""
    again = df.groupBy(*keys).count().where("count > 1").select(F.xxhash64(*keys).alias("key"))
    return bit_words(written(again, name), max_bits)


def surviving_groups(texts: DataFrame, prefix: int = PREFIX, max_bits: int = MAX_BITS) -> tuple[DataFrame, int]:
    """Bit map of the (length, prefix hash) pairs of the column `_text` that more than one row has."""
    narrow = written(texts.select(*_first_look(prefix)), "lengths")
    lengths = _seen_again(narrow, ["_length"], "length_groups", max_bits)
    left = marked(narrow, F.xxhash64("_length"), lengths, "_again").where("_again")
    return _seen_again(left, ["_length", "_prefix"], "prefix_groups", max_bits)


def _first_look(prefix: int) -> list[Column]:
    return [
        F.octet_length("_text").cast("long").alias("_length"),
        F.xxhash64(F.substring("_text", 1, prefix)).alias("_prefix"),
    ]


def with_full_hash(docs: DataFrame, text: str, prefix: int, max_bits: int) -> tuple[Inner, DataFrame]:
    """The input's columns, `_text` (normalised) and `_full`: the hash of rows in surviving groups, else null."""
    inner = Inner(docs)
    texts = inner.df.withColumn("_text", normalized(inner.text(text)))
    groups = surviving_groups(texts, prefix, max_bits)
    looked = texts.select("*", *_first_look(prefix))
    found = marked(looked, F.xxhash64("_length", "_prefix"), groups, "_survives")
    return inner, found.withColumn("_full", F.when(F.col("_survives"), full_hash(F.col("_text")))).drop(
        "_length", "_prefix", "_survives"
    )


def exact_duplicates(
    docs: DataFrame,
    keep: list[str],
    id: str = "doc_id",
    text: str = "text",
    more: dict[str, Callable[[Column], Column]] | None = None,
    prefix: int = PREFIX,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per input row: the columns `keep`, `keep_id` (least id of the equal texts), `group_size` and `kept`.

    `more` names further columns made from the normalised text. What is stored and shuffled holds no text.
    """
    inner, hashed = with_full_hash(docs, text, prefix, max_bits)
    kept = list(dict.fromkeys([inner[id], *(inner[c] for c in keep)]))
    made = {name: make(F.col("_text")) for name, make in (more or {}).items()}
    rows = written(
        hashed.select(F.monotonically_increasing_id().alias("_row"), "_full", *kept, *(c.alias(n) for n, c in made.items())),
        "hashes",
    )
    groups = written(_groups(rows.where("_full IS NOT NULL"), inner[id]), "copies")
    alone = rows.where("_full IS NULL").select(
        "*", F.col(inner[id]).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    limit = rows.count() // HEAVY
    heavy = groups.where(F.col("group_size") > limit)  # fewer than HEAVY rows, hence broadcast
    rest = rows.where("_full IS NOT NULL").join(F.broadcast(heavy.select("_full")), "_full", "left_anti")
    light = groups.where(F.col("group_size") <= limit)
    found = [
        joined.withColumn("kept", F.col("_row") == F.col("_first")).select(*alone.columns)
        for joined in (rows.join(F.broadcast(heavy), "_full"), rest.join(light, "_full"))
    ]
    results = [*made, *RESULTS]
    together = alone.union(found[0]).union(found[1])
    names = [c for c in keep if c not in results]
    return together.select(*(F.col(inner[c]).alias(c) for c in names), *results)


def _groups(rows: DataFrame, id: str) -> DataFrame:
    """Per full hash: least id, number of rows, and the row that stays. Rows equal in id as well are reduced first."""
    ids = rows.groupBy("_full", id).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    first = F.coalesce(F.min_by("_first", id), F.min("_first"))  # all ids null: there is one such row
    return ids.groupBy("_full").agg(
        F.min(id).alias("keep_id"), F.sum("_n").alias("group_size"), first.alias("_first")
    )


def drop_exact_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", prefix: int = PREFIX, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows that stay, whole. Copies are dropped in the task that reads them: only a task's first row of each
    surviving group goes on, so a group with a third of all rows shuffles one row a task. Of rows equal in text and id
    the one whose columns have the least hash stays.
    """
    inner, hashed = with_full_hash(docs, text, prefix, max_bits)
    comparable = [k for k, f in zip(inner.kept, docs.schema.fields) if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = Window.partitionBy("_full").orderBy(F.col(inner[id]).asc_nulls_last(), F.xxhash64(*comparable))
    first = hashed.where("_full IS NOT NULL").drop("_text").withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    alone = hashed.where("_full IS NULL")
    return inner.outer(alone.select(*inner.kept).union(first.select(*inner.kept)))
