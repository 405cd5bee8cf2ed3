"""WARC revisit records resolved against the captures they refer to.

A `revisit` record with a not-modified profile has no body: the server said 304. It is joined to the latest earlier
full response of the same canonical URL (as-of join), its validators are checked against that response's, and
where they agree the result has the stored body, with the stored headers updated by those headers of the 304
that may change them.

The as-of join is cut into buckets, ranges of the order by URL and capture time whose cut points are a sample of the
captures themselves; a bucket holds about as many of them however they lie in time, so no URL is gathered whole: inside a bucket a window carries the last response forward; across buckets only one row per
bucket is carried. Bodies take part only in the last join, from a response to the revisits that chose it.

Defined results: records are identified by `record_id`; equal capture times of a URL count as one moment, at which the
response with the greatest id stands; a null URL, time (an unreadable date is one) or id never matches; a revisit without any validator
is `unvalidated` and gets no body; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ranks import with_ranges
from .frames import written
from .url_filter import host_and_path

BUCKET = 4096
MAX_BUCKETS = 1 << 14  # bounds the list of cut points; beyond it buckets get larger
# Headers a 304 must not change, because they describe the message that carries them.
NOT_MERGED = """connection content-encoding content-length content-md5 content-range content-type keep-alive
proxy-authenticate proxy-authorization proxy-connection te trailer transfer-encoding upgrade""".split()
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid)"


def canonical_url(url: Column) -> Column:
    """Host without `www.` or `m.`, path without a closing slash or `.html`, query parameters sorted, without tracking ones;
    no scheme and no fragment. Null where there is no host."""
    host, path = host_and_path(url)
    bare = F.regexp_replace(F.regexp_replace(host, r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path, r"(\.html)?/*$", ""), "^$", "/")
    query = F.regexp_extract(url, r"^[^#?]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (F.length(p) > 0) & ~p.rlike(rf"^{TRACKING}="))
    return F.when(F.length(host) > 0, F.concat(bare, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise("")))


def header_lines(block: Column) -> Column:
    """`name: value` lines of a header block as (name in lower case, value), blank lines left out."""
    lines = F.filter(F.split(block, r"\r?\n"), lambda x: F.instr(x, ":") > 1)
    return F.transform(lines, lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"),
        F.trim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1)).alias("value"),
    ))


def header(lines: Column, name: str) -> Column:
    """The first value of a header; null where there is none."""
    return F.get(F.filter(lines, lambda x: x["name"] == name), 0)["value"]


def parse_records(records: DataFrame, raw: str = "raw") -> DataFrame:
    """WARC records as text -> record_id, kind, url, at, profile, status, headers, body and validators.

    Dates may have fractions of a second or a lower precision; an unreadable one is null.
    """
    parts = F.split(F.col(raw), r"\r\n\r\n", 3)
    warc, http = header_lines(F.get(parts, 0)), header_lines(F.get(parts, 1))
    return records.select(warc.alias("warc"), http.alias("headers"), parts.alias("parts")).select(
        header(F.col("warc"), "warc-record-id").alias("record_id"),
        header(F.col("warc"), "warc-type").alias("kind"),
        header(F.col("warc"), "warc-target-uri").alias("url"),
        F.try_to_timestamp(header(F.col("warc"), "warc-date")).alias("at"),
        header(F.col("warc"), "warc-profile").alias("profile"),
        F.regexp_extract(F.get("parts", 1), r"^HTTP/[\d.]+ (\d{3})", 1).alias("status"),
        "headers",
        F.coalesce(F.get("parts", 2), F.lit("")).alias("body"),
        header(F.col("headers"), "etag").alias("etag"),
        header(F.col("headers"), "last-modified").alias("last_modified"),
        header(F.col("warc"), "warc-payload-digest").alias("digest"),
    )


def bucketed(moments: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Add `bucket`, numbers that grow with (key, at), of about `bucket` rows each."""
    n = -(-moments.count() // bucket)
    ranges = min(MAX_BUCKETS, 1 << max(1, (n - 1).bit_length()))
    return with_ranges(moments, ["key", "at"], ranges=ranges).withColumnRenamed("_range", "bucket")


def latest_earlier(moments: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """moments: one row per (key, at), with `found` (null where there is none). Adds `earlier`, the last `found` of the
    key before `at`."""
    dealt = bucketed(written(moments, "moments"), bucket)
    lasts = dealt.filter("found is not null").groupBy("key", "bucket").agg(F.max_by("found", "at").alias("last"))
    chain = dealt.select("key", "bucket").distinct().join(lasts, ["key", "bucket"], "left")
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = chain.select("key", "bucket", F.last("last", ignorenulls=True).over(before).alias("carried"))
    inside = Window.partitionBy("key", "bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("own", F.last("found", ignorenulls=True).over(inside))
    return own.join(carried, ["key", "bucket"]).select("key", "at", F.coalesce("own", "carried").alias("earlier"))


def validators_agree(revisit: dict[str, Column], stored: dict[str, Column]) -> Column:
    """The strongest validator that the revisit names decides: entity tag (weak comparison), then modification date, then
    payload digest. Null where it names none."""

    def tag(x: Column) -> Column:
        return F.regexp_replace(x, r"^W/", "")

    same = [
        (revisit["etag"], tag(revisit["etag"]).eqNullSafe(tag(stored["etag"]))),
        (revisit["last_modified"], revisit["last_modified"].eqNullSafe(stored["last_modified"])),
        (revisit["digest"], revisit["digest"].eqNullSafe(stored["digest"])),
    ]
    answer = F.lit(None).cast("boolean")
    for named, agrees in reversed(same):
        answer = F.when(named.isNotNull(), agrees).otherwise(answer)
    return answer


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored headers, with those that the 304 gives anew and may change replaced; sorted by name and value."""
    allowed = F.filter(fresh, lambda x: ~x["name"].isin(NOT_MERGED))
    kept = F.filter(stored, lambda x: ~F.exists(allowed, lambda y: y["name"] == x["name"]))
    return F.array_sort(F.concat(kept, allowed))


def resolve_revisits(records: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per revisit: record_id, url, at, `outcome` (resolved, mismatch, unvalidated, missing, other), `refers_to`, merged
    `headers` and `body` (both null unless resolved).

    Only not-modified revisits are looked up: those whose profile says so, and those without a profile whose status is 304 or
    absent. Others, such as identical payloads of a full response, have the outcome `other`.
    """
    # parsed once; the steps below then read only their columns, bodies only the last one
    keyed = written(records.withColumn("key", canonical_url("url")), "records")
    full = keyed.filter((F.col("kind") == "response") & (F.col("status") == "200"))
    revisits = keyed.filter(F.col("kind") == "revisit")
    not_modified = F.coalesce(F.col("profile").contains("not-modified"), F.col("status").isin("304", ""), F.lit(True))
    checks = ["record_id", "etag", "last_modified", "digest"]

    usable = F.col("key").isNotNull() & F.col("at").isNotNull()
    stored = full.filter(usable & F.col("record_id").isNotNull()).select("key", "at", F.struct(*checks).alias("found"))
    looked_up = revisits.filter(usable & not_modified)
    asked = looked_up.select("key", "at", F.lit(None).cast(stored.schema["found"].dataType).alias("found"))
    moments = stored.union(asked).groupBy("key", "at").agg(F.max("found").alias("found"))
    earlier = latest_earlier(moments, bucket)

    matched = looked_up.join(earlier, ["key", "at"], "left")
    agrees = validators_agree({c: F.col(c) for c in checks[1:]}, {c: F.col(f"earlier.{c}") for c in checks[1:]})
    outcome = (
        F.when(F.col("earlier").isNull(), "missing").when(F.col("agrees").isNull(), "unvalidated")
        .when(F.col("agrees"), "resolved").otherwise("mismatch")
    )
    judged = matched.withColumn("agrees", agrees).select(
        "record_id", "url", "at", outcome.alias("outcome"), F.col("earlier.record_id").alias("refers_to"),
        F.col("headers").alias("fresh"),
    )
    rest = revisits.filter(~(usable & not_modified)).select(
        "record_id", "url", "at", F.when(not_modified, "missing").otherwise("other").alias("outcome"),
        F.lit(None).cast("string").alias("refers_to"), F.lit(None).cast(keyed.schema["headers"].dataType).alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    bodies = full.select(F.col("record_id").alias("stored_id"), F.col("headers").alias("stored"), "body")
    bodies = bodies.dropDuplicates(["stored_id"])
    resolved = F.col("outcome") == "resolved"
    # A revisit that is not resolved wants no body; it gets a key of its own, which no record id equals, so that these
    # rows do not meet in one task.
    own = F.concat(F.lit("\0"), F.xxhash64("record_id", "url", "at").cast("string"))
    joined = judged.withColumn("wanted", F.when(resolved, F.col("refers_to")).otherwise(own)).join(
        bodies, F.col("wanted") == F.col("stored_id"), "left"
    )
    return joined.select(
        "record_id", "url", "at", "outcome", "refers_to",
        F.when(resolved, merged_headers(F.col("stored"), F.col("fresh"))).alias("headers"),
        F.when(resolved, F.col("body")).alias("body"),
    ).union(rest)
