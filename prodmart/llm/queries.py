"""One query for each operator over its whole table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat_windows as chat, line_quality, toxicity
from .decontaminate import contaminated
from .exact_dedup import exact_duplicates, full_hash, normalized
from .frames import held_out, training_texts, written
from .html_text import extract_text
from .jaccard_join import near_duplicates
from .periodic_runs import periodic_runs
from .quality_rules import MEASURES, quality_measures
from .revisits import parse_records, resolve_revisits
from .segmentations import segmentations_only
from .url_filter import filter_urls
from .whitening import fit_whitening, identity_error, whiten

QUALITY_LIMIT = 0.3
TOXICITY_LIMIT = 0.5
SEGMENTATIONS = 3
COMPONENTS = 32

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
BLOCKED_HOSTS = [
    "spam-farm.example.org", "cheap-pills.example.com", "casino-win.example.org", "free-bets.example.com", "ads-track.example.org",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item"])))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    samples = training_texts(docs, table(spark, sf_dir, "labels"), "quality", line_quality.Fit().sample)
    scored = line_quality.score_quality(docs, line_quality.fit_lines(samples))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= QUALITY_LIMIT).cast("int").alias("predicted"), "good_share", "n_lines", "n_bad_lines",
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def captures(pages: DataFrame) -> DataFrame:
    """WARC records made from pages: each page is a full response, and later captures of its URL were not modified.

    The capture of page p is at minute 1000 * p; revisits follow after (p mod 5000) and after 1000 * (p mod 7) + 1
    minutes. Entity tags are the pages' digests; of the revisits, some name a changed tag, some only a
    modification date or payload digest, some nothing. A page without an id counts as page -1.
    """
    p, nl = F.coalesce("page_id", F.lit(-1)), F.lit("\r\n")
    body = F.coalesce("html", F.lit(""))
    digest = F.md5(body.cast("binary"))

    def day(minute):  # noqa: ANN001, ANN202
        return F.date_format(F.timestamp_seconds(F.lit(1600000000) + minute * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def record(kind, number, minute, extra, http, text):  # noqa: ANN001, ANN202
        return F.concat(
            F.lit("WARC/1.0"), nl, F.lit(f"WARC-Type: {kind}"), nl, F.lit("WARC-Record-ID: "),
            F.concat(F.lit(f"{number}-"), F.lpad(p.cast("string"), 12, "0")), nl,
            F.lit("WARC-Target-URI: "), F.coalesce("url", F.lit("")), nl, F.lit("WARC-Date: "), day(minute), nl, extra,
            nl, http, nl, text,
        )

    modified = F.concat(F.lit("Last-Modified: "), day(p * 1000), nl)
    ok = F.concat(
        F.lit("HTTP/1.1 200 OK"), nl, F.lit("ETag: \""), digest, F.lit("\""), nl, modified, F.lit("Content-Type: text/html"), nl,
        F.lit("Content-Length: "), F.length(body).cast("string"), nl, F.lit("Cache-Control: max-age=60"), nl,
    )
    named = (
        F.when(p % 7 == 0, F.lit("ETag: \"changed\"\r\n")).when(p % 7 == 1, modified).when(p % 7 == 2, F.lit(""))
        .otherwise(F.concat(F.lit("ETag: W/\""), digest, F.lit("\""), nl))
    )
    fresh = F.concat(F.lit("HTTP/1.1 304 Not Modified"), nl, named, F.lit("Cache-Control: max-age=90"), nl, F.lit("Content-Length: 0"), nl)
    payload = F.when(p % 7 == 2, F.when(p % 2 == 0, F.concat(F.lit("WARC-Payload-Digest: md5:"), digest, nl)).otherwise("")).otherwise("")
    own = F.concat(F.lit("WARC-Payload-Digest: md5:"), digest, nl)
    return pages.select(F.explode(F.array(
        record("response", "a", p * 1000, own, ok, body),
        record("revisit", "b", p * 1000 + p % 5000, payload, fresh, F.lit("")),
        record("revisit", "c", p * 1000 + p % 7 * 1000 + 1, payload, fresh, F.lit("")),
    )).alias("raw"))


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_revisits(parse_records(captures(table(spark, sf_dir, "pages"))))
    names = F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    return resolved.select(
        "record_id", F.unix_seconds("at").alias("second"), "outcome", "refers_to",
        F.array_join(names, "\n").alias("headers"), F.length("body").cast("long").alias("body_chars"),
        F.md5(F.col("body").cast("binary")).alias("body_md5"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    samples = training_texts(docs, table(spark, sf_dir, "labels"), "toxic", toxicity.Fit().sample)
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(samples))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXICITY_LIMIT).cast("int").alias("predicted"), "n_sentences", "offending",
    )


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "copy_id", "n_copies", F.hex("class_hash").alias("class_hash"))


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn int, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.chat_windows(turns))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_measures(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["doc_id"])
    return found.select("doc_id", *MEASURES, "base_failed", "host_rejected", "kept")


def op9_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return segmentations_only(docs, ["doc_id"], SEGMENTATIONS)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, RULES, BLOCKED_HOSTS).select("page_id", "host", "path", "rule", "verdict")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(vectors, components=COMPONENTS)
    rows = written(whiten(vectors, model).select("vec_id", "deviation", "whitened"), "whitened")
    error = identity_error(rows, model.n, len(model.components))
    explained = F.array(*(F.lit(x) for x in model.explained)).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_duplicates(docs, ["doc_id"], more={"text_sha256": full_hash}).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document by the crc32 of its id gets a tail that repeats its first words; a null id is left alone."""
    blank_free = F.trim(normalized(F.col("text")))
    known = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    chosen = known.withColumn("w", F.when((F.col("h") % 10 == 0) & (blank_free != ""), F.split(blank_free, " ")))
    sized = chosen.withColumn("g", F.expr("h DIV 10")).withColumn("n", F.size("w"))
    cut = sized.withColumn("a", F.expr("CAST(if(n > 0, g % n, 0) AS INT)"))
    repeated = cut.withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    tail = "slice(flatten(array_repeat(slice(w, a + 1, p), CAST(ceil((n - a) / p) AS INT))), 1, n - a)"
    planted = F.expr(f"array_join(concat(slice(w, 1, a), {tail}), ' ')")
    return repeated.select("doc_id", F.when(F.col("w").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(with_planted_runs(docs)).select("doc_id", "runs", "collapsed")
    best = F.expr("""aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
        (best, r) -> if(best IS NULL OR r.length * best.period > best.length * r.period, r, best))""")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_line_quality, op3_html_text, op4_revisits, op5_toxicity, op6_near_duplicates,
        op7_chat_windows, op8_quality_rules, op9_segmentations, op10_url_filter, op11_whitening, op12_exact_dedup,
        op13_periodic_runs,
    )
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SOLID = r"[^\x20\x09-\x0D]+"

ORACLE = {
    "op1_decontamination": rf"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
            FROM documents
        ), item AS (
            SELECT CAST(item_id AS VARCHAR) AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
            FROM benchmark
        ), item_window AS (
            SELECT DISTINCT id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
            FROM (SELECT id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
        ), doc_window AS (
            SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)
        ), hit AS (
            SELECT doc_id, id, i, n FROM doc_window JOIN item_window USING (n, gram)
        ), inside AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hit) GROUP BY 1
        ), listed AS (
            SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, id FROM hit) GROUP BY 1
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN inside USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
    "op4_revisits": r"""
        WITH page AS (
            SELECT coalesce(page_id, -1) AS p, coalesce(html, '') AS body, '"' || md5(coalesce(html, '')) || '"' AS tag,
                   split_part(regexp_replace(substr(url, strpos(url, '://') + 3), '^[A-Za-z0-9.-]*', ''), '#', 1) AS tail,
                   regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^(www|m)\.', '') AS host
            FROM pages
        ), canon AS (
            SELECT *, host || coalesce(nullif(regexp_replace(split_part(tail, '?', 1), '(\.html)?/*$', ''), ''), '/')
                || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(split_part(tail, '?', 2), '&'),
                    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))), '&'), ''), '') AS key
            FROM page
        ), stored AS (
            SELECT key, p * 1000 AS minute, max_by(p, p) AS p, max_by(tag, p) AS tag, max_by(body, p) AS body FROM canon GROUP BY 1, 2
        ), asked AS (
            SELECT 'b' AS kind, p, key, p * 1000 + p % 5000 AS minute, tag FROM canon
            UNION ALL SELECT 'c', p, key, p * 1000 + p % 7 * 1000 + 1, tag FROM canon
        ), matched AS (
            SELECT a.kind, a.p, a.minute, a.tag, s.p AS sp, s.tag AS stag, s.body
            FROM asked a ASOF LEFT JOIN stored s ON a.key = s.key AND a.minute > s.minute
        ), judged AS (
            SELECT *, CASE WHEN sp IS NULL THEN 'missing'
                WHEN p % 7 = 0 THEN 'mismatch'
                WHEN p % 7 = 1 THEN if(p = sp, 'resolved', 'mismatch')
                WHEN p % 7 = 2 AND p % 2 = 1 THEN 'unvalidated'
                ELSE if(tag = stag, 'resolved', 'mismatch') END AS outcome
            FROM matched
        )
        SELECT kind || '-' || lpad(CAST(p AS VARCHAR), 12, '0') AS record_id, 1600000000 + minute * 60 AS second, outcome,
               'a-' || lpad(CAST(sp AS VARCHAR), 12, '0') AS refers_to,
               CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=90' || chr(10) || 'content-length: ' || length(body) || chr(10)
                   || 'content-type: text/html' || chr(10) || 'etag: ' || if(p % 7 IN (1, 2), '', 'W/') || stag || chr(10)
                   || 'last-modified: ' || strftime(to_timestamp(1600000000 + sp * 60000) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') END AS headers,
               CASE WHEN outcome = 'resolved' THEN CAST(length(body) AS BIGINT) END AS body_chars,
               CASE WHEN outcome = 'resolved' THEN md5(body) END AS body_md5
        FROM judged
    """,
    "op8_quality_rules": rf"""
        WITH doc AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '{SOLID}') AS w
            FROM documents
        ), line AS (
            SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
            FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM doc) WHERE regexp_matches(line, '{SOLID}') GROUP BY 1
        ), five AS (
            SELECT r, i, array_to_string(w[i:i + 4], ' ') AS gram
            FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM doc WHERE len(w) > 4)
        ), again AS (
            SELECT r, unnest(range(i, i + 5)) AS place
            FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM five) WHERE n > 1
        ), repeats AS (
            SELECT r, count(DISTINCT place) AS n_repeat_words FROM again GROUP BY 1
        ), measured AS (
            SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM doc LEFT JOIN line USING (r) LEFT JOIN repeats USING (r)
        ), judged AS (
            SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2, 100 * n_symbols > 25 * word_chars AS f3,
                   100 * n_dup_lines > 30 * n_lines AS f4
            FROM measured
        ), rule AS (
            UNPIVOT (SELECT host, count(*) AS n, sum(CAST(f1 AS INT)) AS r1, sum(CAST(f2 AS INT)) AS r2, sum(CAST(f3 AS INT)) AS r3,
                     sum(CAST(f4 AS INT)) AS r4 FROM judged GROUP BY host) ON r1, r2, r3, r4 INTO NAME rule VALUE f
        ), total AS (
            SELECT rule, sum(f) / sum(n) AS m, count(*) / sum(n) AS hosts, sum(f * f / n) / sum(n) AS squares FROM rule GROUP BY 1
        ), prior AS (
            SELECT rule, m, m * (1 - m) AS chance, greatest(squares - m * m - m * (1 - m) * hosts, 0) AS between FROM total
        ), strength AS (
            SELECT rule, m, CASE WHEN between > 0 THEN least(greatest(chance / between - 1, 1), 1e6) ELSE 1e6 END AS k FROM prior
        ), verdict AS (
            SELECT host, max((f + m * k) / (n + k)) > 0.5 AS host_rejected FROM rule JOIN strength USING (rule) GROUP BY 1
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed, host_rejected,
               NOT (f1 OR f2) AND NOT host_rejected AS kept
        FROM judged JOIN verdict USING (host)
    """,
    "op12_exact_dedup": r"""
        WITH doc AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
        FROM doc
    """,
    "op10_url_filter": r"""
        WITH page AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), cut AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM page
        ), ruled AS (
            SELECT *, CASE
                WHEN regexp_matches(host, '(^|\.)example\.net$') AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN regexp_matches(host, '(^|\.)example\.com$') AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN regexp_matches(host, '(^|\.)org$') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN regexp_matches(host, '(^|\.)net$') AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM cut
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(host, '(^|\.)(spam-farm\.example\.org|cheap-pills\.example\.com|casino-win\.example\.org|free-bets\.example\.com|ads-track\.example\.org)$')
            THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled
    """,
}
