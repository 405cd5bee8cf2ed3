"""URL filters by a cascade of Bloom filters.

Level 1 encodes the listed keys. Level 2 encodes those other keys of the corpus that level 1 lets through by
mistake, level 3 the listed keys that level 2 catches by mistake, and so on until no mistake is left. A key of
the corpus is listed if it first misses an even level (or passes all of an odd number of levels): membership is
exact for the complete key universe, and asking needs a few bit look-ups and no join.

Keys are `host/path/`: a host or any parent domain of it, with a prefix of the path that ends in a slash. A URL has
one key for each of its last host labels and first path segments, up to what the lists use; and, whether it has a path or
not, `host/` for each of those labels. The universe holds all of these.

Everything here is DataFrame expressions. A bitmap has at most `max_bits` bits. A list too long for that is split by the
hash of its keys into shards with a cascade each, and the rows are asked shard after shard with a written table between,
so the bitmaps in memory at a time stay bounded however long the list is. Short lists, the common case, take one pass.

Defined results: a null URL, or one without `://`, has an empty host and path and matches nothing, so it gets
the default verdict; rows repeat as they come; empty tables and empty lists work; a key listed twice with
different verdicts is blocked; a result column replaces an input column of its name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .frames import Inner, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, lower-cased; path: then up to `?`, `#` or the end."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Level:
    """One Bloom filter: the stored bitmap (one row, `words`), its size in bits and its number of hashes."""

    table: DataFrame
    bits: int
    hashes: int
    salt: int

    def holds(self, key: Column) -> Column:
        words = self.table.select("words").scalar()
        found = []
        for i in range(self.hashes):
            at = _position(key, self.salt, i, self.bits)
            found.append(F.getbit(F.get(words, (at / 64).cast("int")), (at % 64).cast("int")) == 1)
        return reduce(Column.__and__, found)


def _position(key: Column, salt: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1000 * salt + i)), F.lit(bits).cast("long"))


def build_level(keys: DataFrame, n: int, salt: int, bits_per_key: int, max_bits: int) -> Level:
    """Encode `keys` (column key, n rows): bits are set per word before anything meets, and the bitmap has a fixed size."""
    spark = keys.sparkSession
    bits = min(max(64, 1 << (n * bits_per_key - 1).bit_length()), max_bits)
    hashes = max(1, min(6, round(0.7 * bits / max(n, 1))))
    at = F.explode(F.array(*(_position(F.col("key"), salt, i, bits) for i in range(hashes))))
    marks = keys.select(at.alias("at")).select(
        (F.col("at") / 64).cast("long").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit")
    )
    empty = spark.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bit"))
    words = marks.union(empty).groupBy("word").agg(F.bit_or("bit").alias("bit"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bit")))
    table = words.agg(F.transform(ordered, lambda x: x["bit"]).alias("words"))
    return Level(written(table, "bitmap"), bits, hashes, salt)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels), 0, -1):
            missed = F.lit(depth % 2 == 0)
            answer = F.when(self.levels[depth - 1].holds(key), answer).otherwise(missed)
        return F.when(key.isNull(), F.lit(False)).otherwise(answer)


def build_cascade(
    universe: DataFrame, listed: DataFrame, bits_per_key: int = 10, max_bits: int = 1 << 27, max_levels: int = 40
) -> Cascade:
    """One cascade. universe: every key of the corpus; listed: the listed ones. Both have the column `key`.

    Raises when `max_bits` is too little for the list; `build_shards` splits such a list.
    """
    return _cascade(_marked(universe, listed), bits_per_key, max_bits, max_levels)


def _marked(universe: DataFrame, listed: DataFrame) -> DataFrame:
    """The keys of the universe, `listed` or NULL: the one join with the list."""
    marked = listed.select("key").distinct().withColumn("listed", F.lit(True))
    return written(universe.select("key").distinct().join(marked, "key", "left"), "keys")


def _cascade(keys: DataFrame, bits_per_key: int, max_bits: int, max_levels: int) -> Cascade:
    """Each level after the first only rereads the keys that the level before got wrong."""
    inside, outside = keys.filter("listed").select("key"), keys.filter("listed is null").select("key")
    levels: list[Level] = []
    n = inside.count()
    while n and len(levels) < max_levels:
        level = build_level(inside, n, len(levels), bits_per_key, max_bits)
        levels.append(level)
        mistaken = written(outside.filter(level.holds(F.col("key"))), "mistaken")
        inside, outside, n = mistaken, inside, mistaken.count()
    if n:
        raise ValueError(f"{n} keys are still mistaken after {max_levels} levels: raise max_bits")
    return Cascade(tuple(levels))


@dataclass(frozen=True)
class Shards:
    """Cascades of the parts of a list; a key belongs to the part its hash names."""

    parts: tuple[Cascade, ...]

    def part(self, key: Column) -> Column:
        return _part(key, len(self.parts))

    def lists(self, key: Column, at: int) -> Column:
        """Whether a key of part `at` is listed, false for keys of other parts."""
        if at >= len(self.parts):
            return F.lit(False)
        found = self.parts[at].lists(key)
        return found if len(self.parts) == 1 else F.when(self.part(key) == at, found).otherwise(False)


def _part(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(n).cast("long"))


def build_shards(
    universe: DataFrame, listed: DataFrame, bits_per_key: int = 10, max_bits: int = 1 << 27, max_levels: int = 40
) -> Shards:
    """As many cascades as the list needs for `bits_per_key` bits a key in bitmaps of at most `max_bits`.

    The marked universe is written once, in a directory per shard when there are several, so that a shard's levels
    read its own keys alone.
    """
    keys = _marked(universe, listed)
    n = keys.agg(F.count("listed")).first()[0]
    shards = max(1, -(-n * bits_per_key // max_bits))
    if shards == 1:
        return Shards((_cascade(keys, bits_per_key, max_bits, max_levels),))
    parted = written(keys.withColumn("part", _part(F.col("key"), shards)), "shards", "part")
    return Shards(tuple(_cascade(parted.filter(F.col("part") == i), bits_per_key, max_bits, max_levels) for i in range(shards)))


def ask(rows: DataFrame, asked: dict[str, tuple[Shards, Column]]) -> DataFrame:
    """Add a boolean column per entry: whether its list holds its key.

    Lists of one shard are asked in the plan itself. Each further shard is a pass over the rows whose result is written,
    which frees the bitmaps of the shard before.
    """
    rows = rows.withColumns({name: shards.lists(key, 0) for name, (shards, key) in asked.items()})
    for at in range(1, max(len(shards.parts) for shards, _ in asked.values())):
        more = {name: F.col(name) | shards.lists(key, at) for name, (shards, key) in asked.items() if at < len(shards.parts)}
        rows = written(rows, "asked").withColumns(more)
    return rows


def url_keys(host: Column, path: Column, labels: int, segments: int) -> list[Column]:
    """The keys of a URL: its last 1 to `labels` host labels with its first 1 to `segments` path parts; NULL where it has fewer."""
    parts = F.split(host, r"\.")
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/")))
    made = []
    for n in range(1, labels + 1):
        suffix = F.when(F.size(parts) >= n, F.substring_index(host, ".", -n))
        for k in range(1, segments + 1):
            prefix = F.when(slashes >= k, F.concat(F.substring_index(path, "/", k), F.lit("/")))
            made.append(F.concat(suffix, prefix))
    return made


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str]] | DataFrame, blocked_hosts: list[str] | DataFrame, url: str = "url",
    default: str = "allow", max_bits: int = 1 << 27,
) -> DataFrame:
    """The input with `host`, `path`, `rule` and `verdict`.

    rules: (verdict, key), the key being a host, a slash and a path that is empty or ends in a slash. A rule fits its
    host and all subdomains when the URL's path starts with the rule's; the longest that fits wins. Where
    none fits, a URL below one of `blocked_hosts` is blocked and any other gets the default.

    Lists too long for the driver are frames: rules with the columns verdict and key, hosts with the column host. Their
    null hosts list nothing.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(rules, "verdict string, key string")
    if not isinstance(blocked_hosts, DataFrame):
        blocked_hosts = spark.createDataFrame([(h,) for h in blocked_hosts], "host string")
    well_formed = F.col("verdict").isin("allow", "block") & F.col("key").endswith("/") & ~F.col("key").startswith("/")
    wrong = rules.filter(~F.coalesce(well_formed, F.lit(False))).head(5)
    if wrong:
        raise ValueError(f"rules are (allow or block, host/path/): {[tuple(r) for r in wrong]}")
    lists = {v: rules.filter(F.col("verdict") == v).select("key") for v in ("allow", "block")}
    lists["host"] = blocked_hosts.filter("host is not null").select(F.concat("host", F.lit("/")).alias("key"))
    every = lists["allow"].union(lists["block"]).union(lists["host"])
    deepest = every.agg(
        F.max(F.size(F.split(F.substring_index("key", "/", 1), r"\."))), F.max(F.size(F.split("key", "/")) - 1)
    ).first()
    labels, segments = deepest[0] or 1, deepest[1] or 1

    inner = Inner(pages)
    host, path = host_and_path(F.col(inner[url]).cast("string"))
    rows = inner.df.withColumns({"host": host, "path": path})
    keys = url_keys(F.col("host"), F.col("path"), labels, segments)
    # host keys have no path beyond the slash, and are asked of URLs without a path too
    hosts = [F.concat(F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n)), F.lit("/"))
             for n in range(1, labels + 1)]
    universe = rows.select(F.explode(F.array(*keys, *hosts)).alias("key")).filter("key is not null")
    universe = written(universe.union(every).distinct(), "universe")
    found = {name: build_shards(universe, ks, max_bits=max_bits) for name, ks in lists.items()}

    rows = rows.withColumns({f"_key{i}": key for i, key in enumerate(keys)})
    rows = rows.withColumns({f"_host{n}": h for n, h in enumerate(hosts)})
    asked = {f"_{v}{i}": (found[v], F.col(f"_key{i}")) for i in range(len(keys)) for v in ("allow", "block")}
    below = {f"_below{n}": (found["host"], F.col(f"_host{n}")) for n in range(len(hosts))}
    rows = ask(rows, {**asked, **below})
    fits = [
        F.when(F.col(f"_{v}{i}"), F.struct(F.length(f"_key{i}").alias("n"), F.lit(v).alias("verdict"), F.col(f"_key{i}").alias("key")))
        for i in range(len(keys)) for v in ("allow", "block")
    ]
    rows = rows.withColumns({"_best": F.greatest(*fits), "_blocked": reduce(Column.__or__, [F.col(name) for name in below])})
    rows = rows.withColumns({
        "rule": F.col("_best.key"),
        "verdict": F.coalesce(F.col("_best.verdict"), F.when(F.col("_blocked"), "block").otherwise(default)),
    })
    return inner.with_results(rows, ["host", "path", "rule", "verdict"])
