"""URL filter, page text, chat windows, revisits and segmentations against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prodmart.llm import chat_windows as chat, segmentations
from prodmart.llm.html_text import extract_text, main_text
from prodmart.llm.piece_lattice import lattices, vocabulary
from prodmart.llm.queries import BLOCKED_HOSTS, RULES
from prodmart.llm.revisits import bucketed, canonical_url, latest_earlier, parse_records, resolve_revisits
from prodmart.llm.textscan import blocks
from prodmart.llm.tokenizers import TOKENIZERS, byte_pair_counter, file_bytes
from prodmart.llm.url_filter import ask, build_cascade, build_shards, filter_urls

# --- URL filter ------------------------------------------------------------------------------------------------------


def test_cascade_is_exact(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = universe.filter(F.xxhash64("key") % 7 == 0)
    for bits in (1, 10):  # one bit a key makes many mistakes, which further levels mend
        cascade = build_cascade(universe, listed, bits_per_key=bits)
        assert bits == 10 or len(cascade.levels) > 3
        wrong = universe.join(listed.withColumn("in", F.lit(True)), "key", "left").filter(
            cascade.lists(F.col("key")) != F.coalesce("in", F.lit(False))
        )
        assert wrong.count() == 0
    assert universe.filter(build_cascade(universe, listed.limit(0)).lists(F.col("key"))).count() == 0


def test_bitmaps_are_bounded(spark):
    universe = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    cascade = build_cascade(universe, universe.filter("cast(key as int) < 600"), max_bits=2048)
    assert max(level.bits for level in cascade.levels) == 2048
    assert universe.filter(cascade.lists(F.col("key"))).agg(F.max(F.col("key").cast("int")), F.count("*")).first() == (599, 600)


def test_long_lists_are_split_into_shards(spark):
    universe = spark.range(12000).select(F.col("id").cast("string").alias("key"))
    listed = universe.filter("cast(key as int) < 8000")
    few = build_shards(universe, listed, max_bits=1 << 15)
    assert len(few.parts) == 3 and max(level.bits for part in few.parts for level in part.levels) <= 1 << 15
    short = build_shards(universe, universe.filter("key = '7'"))
    assert len(short.parts) == 1
    rows = universe.union(universe.limit(1).select(F.lit(None).cast("string")))
    got = ask(rows, {"long": (few, F.col("key")), "short": (short, F.col("key"))}).collect()
    assert len(got) == 12001
    for r in got:
        assert (r.long, r.short) == (r.key is not None and int(r.key) < 8000, r.key == "7")


def test_urls_against_sharded_lists(spark):
    """Lists of several shards, given as frames, decide like plain Python sets."""
    hosts = [f"h{i}.example{i % 7}.com" for i in range(600)]
    urls = [f"http://www.{h}/{p}" for h in hosts for p in ("", "a/", "a/b/x", "b")] + [f"http://{h}" for h in hosts] + [None, "", "x"]
    rules = [("block" if i % 3 else "allow", f"{h}/{'a/' if i % 2 else ''}") for i, h in enumerate(hosts) if i % 5 == 0]
    blocked = [h for i, h in enumerate(hosts) if i % 4 == 1]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    frames = spark.createDataFrame(rules, "verdict string, key string"), spark.createDataFrame([(h,) for h in [*blocked, None]], "host string")
    got = {r.url: (r.rule, r.verdict) for r in filter_urls(pages, *frames, max_bits=512).collect()}

    def expected(url):
        rest = (url or "").partition("://")[2]
        host, _, path = rest.partition("/")
        path = "/" + path if "/" in rest else ""
        below = lambda h: host == h or host.endswith("." + h)
        fits = [(len(k), v, k) for v, k in rules if below(k.split("/", 1)[0]) and path.startswith("/" + k.split("/", 1)[1])]
        if fits:
            _, verdict, key = max(fits)
            return key, verdict
        return None, "block" if any(map(below, blocked)) else "allow"

    assert got == {u: expected(u) for u in urls}


def test_rules_and_urls(spark):
    urls = [
        "http://A.Example.net/en/1", "http://example.net/en", "https://x.net", "https://x.net/", "https://notexample.net/en/",
        "http://b.example.com/de/?q=/en/", "http://b.example.com/en/", "http://x.org/fr/#a", "http://bad.org/en/", "no scheme", "",
        None, "http://", "://w.bad.org", "http://w.bad.org:80/", "http://bad.org?x", "a://b://c/d",
    ]
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    pages = spark.createDataFrame([(u, "mine") for u in urls], "url string, verdict string")
    rows = filter_urls(pages, rules, ["bad.org"]).collect()
    got = [(r.host, r.path, r.rule, r.verdict) for r in sorted(rows, key=lambda r: urls.index(r.url))]
    assert got == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.net", "/en", "net/", "block"), ("x.net", "", None, "allow"),
        ("x.net", "/", "net/", "block"), ("notexample.net", "/en/", "net/", "block"), ("b.example.com", "/de/", "example.com/de/", "block"),
        ("b.example.com", "/en/", None, "allow"), ("x.org", "/fr/", "org/fr/", "allow"), ("bad.org", "/en/", None, "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("w.bad.org", "", None, "block"),
        ("w.bad.org:80", "/", None, "allow"), ("bad.org", "", None, "block"), ("b:", "//c/d", None, "allow"),
    ]
    assert filter_urls(pages.limit(0), rules, []).count() == 0
    with pytest.raises(ValueError):
        filter_urls(pages, [("block", "net")], [])


def test_hosts_without_a_path(spark):
    hosts = [f"host{i}.example.org" for i in range(5000)]
    pages = spark.createDataFrame([(f"http://{h}{('', '?q=1', '#x')[i % 3]}",) for i, h in enumerate([*hosts, *BLOCKED_HOSTS])], "url string")
    rows = filter_urls(pages.union(spark.createDataFrame([("http://",)], "url string")), RULES, BLOCKED_HOSTS).collect()
    assert sorted(r.host for r in rows if r.verdict == "block") == sorted(BLOCKED_HOSTS) and len(rows) == 5006


# --- page text -------------------------------------------------------------------------------------------------------

ARTICLE = "<h1>Head &amp; tail</h1><p>One   two\nthree &lt;b&gt;.</p><p>Short.<p><b>Bold and <i>more</i></b> text<br>here.</p><ul><li>item</ul>"
EXPECTED = "Head & tail\nOne two three <b>.\nShort.\nBold and more text here.\nitem"
AROUND = (
    "<html><head><title>T</title><style>p{}</style><script>var x='<p>no</p>';</script></head><body><header><h1>Site</h1></header>"
    "<nav><ul><li><a href=/>Home</a><li><a href=/a>About us and a long menu entry that goes on</a></ul></nav><div class='ad'>Buy now!</div>%s"
    "<aside>Side</aside><div id=comments><p>Great post, I really liked reading all of this very much!</p></div>"
    "<div class='cookie-notice'>We use cookies</div><form><p>Mail</p><input></form><footer>&copy; all rights reserved by somebody</footer>"
)


@pytest.mark.parametrize("shell", ["<article>%s</article>", "<main>%s</main>", "<div class=content>%s</div>", "<article>%s"])
def test_main_text(shell):
    page = AROUND % (shell % ARTICLE)
    assert main_text(page) == EXPECTED
    assert shell.endswith("%s") or main_text(page + "<!-- no end") == EXPECTED


@pytest.mark.parametrize("shell", [
    "<div class=content><h1>Head</h1><p>Lead words.</p><p>%s</p><p>Last words.</p></div>",
    "<div><div><h1>Head</h1><p>%s</p></div><div><p>The second part of it goes on here.</p></div></div>",
    "<article><h1>Head</h1><p>%s</p></article><article><p>The second part of it goes on here.</p></article>",
    "<main><article><p>%s</p></article><article><p>The second part of it goes on here.</p></article></main>",
])
@pytest.mark.parametrize("n", [2, 8, 40])
def test_whole_article(shell, n):
    page = AROUND % (shell % ("many words " * n).strip())
    expected = re.sub(r"(<[^>]*>)+", "\n", shell % ("many words " * n).strip()).strip()
    assert main_text(page) == expected


def test_pages(spark):
    rows = [(1, None), (2, ""), (3, AROUND % f"<article>{ARTICLE}</article>"), (4, "just words"), (5, "<article><p>" + "long " * 90000 + "</article>")]
    got = extract_text(spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("mine")))
    assert got.columns == ["page_id", "html", "text", "n_chars"]
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts == {1: "", 2: "", 3: EXPECTED, 4: "just words", 5: ("long " * 90000).strip()}
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


# --- chat windows ----------------------------------------------------------------------------------------------------

def test_escaping_is_reversible():
    rng = random.Random(1)
    for _ in range(300):
        turns = [
            ("".join(rng.choice(["user", ":", "\\", "#", "\n", " "]) for _ in range(3)),
             "".join(rng.choice(["### user: ", "</turn>", "\n", "\\", "#", "<", "x", "é"]) for _ in range(rng.randrange(9))))
            for _ in range(3)
        ]
        assert chat.read_turns("".join(chat.format_turn(*t)[0] for t in turns)) == turns


def test_windows_keep_the_budget():
    rng = random.Random(2)
    budget = chat.Budget(tokens=60, history=20)
    for _ in range(200):
        turns = [("system", "be kind")] * rng.randrange(2) + [
            (("user", "assistant")[i % 2], "w " * rng.choice([1, 3, 9, 40, 200])) for i in range(rng.randrange(1, 20))
        ]
        made = list(chat.windows(iter(turns), budget, lambda t: len(t.split())))
        own = [t for w in made for t in chat.read_turns(w.text)[w.repeated :]]
        assert own == turns and [w.number for w in made] == list(range(len(made)))
        for w in made:
            read = chat.read_turns(w.text)
            assert w.tokens == len(w.text.split()) and (w.tokens <= budget.tokens or w.turns == 1)
            if w.number and turns[0][0] == "system":
                assert read[0] == turns[0]
            history = [r for r in read[: w.repeated] if r[0] != "system"]
            assert sum(len(chat.format_turn(*t)[0].split()) for t in history) <= budget.history
            assert [chat.unescape(w.text[a:b]) for a, b in w.loss] == [t for r, t in read[w.repeated :] if r == "assistant" and t]


def test_chat_digests(spark):
    rng = random.Random(3)
    said = "\\### Assistant: </turn> ok"
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice([None, "", said, "é " * 300])) for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += [(None, 0, "user", "x"), (-7, 1, "assistant", said), (-7, 0, "user", said), (5, 2, "assistant", "tie"), (5, 2, "assistant", "tie"), (8, None, "user", "y")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.chat_windows(frame, chat.Budget(tokens=400, history=90))).collect()}
    assert set(got) == {r[0] for r in rows}
    for key, row in got.items():
        turns = sorted([(-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == key])
        targets = "".join(x for _, r, x in turns if r == "assistant")
        assert row.n_turns == len(turns) and row.loss_chars == len(targets)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(targets.encode()).hexdigest()
    made = chat.chat_windows(frame, chat.Budget(tokens=400, history=90))
    count = byte_pair_counter(file_bytes(f"{TOKENIZERS}/byte_bpe_50k.tiktoken"))
    for w in made.collect():
        assert w.n_tokens == sum(count(chat.format_turn(*t)[0]) for t in chat.read_turns(w.text))
    assert chat.chat_windows(frame.limit(0)).count() == 0


# --- revisits --------------------------------------------------------------------------------------------------------

def test_canonical_urls(spark):
    urls = ["http://www.A.com/x.html?b=2&utm_source=q&a=1#z", "https://m.a.com:443/x/?a=1&b=2", "http://a.com", "nothing", None]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    got = {r.i: r.key for r in frame.select("i", canonical_url(F.col("url")).alias("key")).collect()}
    assert got == {0: "a.com/x?a=1&b=2", 1: "a.com/x?a=1&b=2", 2: "a.com/", 3: None, 4: None}


@pytest.mark.parametrize("bucket", [4096, 3])
def test_latest_earlier(spark, bucket):
    rng = random.Random(4)
    rows = sorted({(rng.choice("ab"), rng.randrange(300)) for _ in range(200)})
    rows = [(k, t, rng.choice([None, f"{k}{t}"])) for k, t in rows]
    frame = spark.createDataFrame(rows, "key string, s long, found string").withColumn("at", F.timestamp_seconds("s"))
    got = {(r.key, r.s): r.earlier for r in latest_earlier(frame.drop("s"), bucket).withColumn("s", F.unix_seconds("at")).collect()}
    for k, t, _ in rows:
        before = [x for x in rows if x[0] == k and x[1] < t and x[2]]
        assert got[k, t] == (before[-1][2] if before else None)


def test_buckets_follow_the_captures(spark):
    # one URL with a stray date and a burst
    rows = [("a", 0)] + [("a", 1_700_000_000 + i) for i in range(6000)] + [(f"k{i}", i) for i in range(50)]
    frame = spark.createDataFrame(rows, "key string, s long").select("key", F.timestamp_seconds("s").alias("at"))
    dealt = bucketed(frame, 64).groupBy("key", "bucket").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).collect()
    assert max(r.n for r in dealt) <= 64 * 8 and sum(r.n for r in dealt) == len(rows)
    own = sorted((r for r in dealt if r.key == "a"), key=lambda r: r.bucket)
    assert all(x.high < y.low for x, y in zip(own, own[1:]))


def record(kind, number, url, minute, http="", warc="", body=""):
    status = "HTTP/1.1 200 OK" if kind == "response" else "HTTP/1.1 304 Not Modified"
    return (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {number}\r\nWARC-Target-URI: {url}\r\n"
        f"WARC-Date: 2024-01-01T00:{minute:02d}:00Z{warc}\r\n\r\n{status}\r\n{http}\r\n\r\n{body}"
    )


def test_revisits(spark, nothing):
    raw = [
        record("response", "r1", "http://a.com/x", 1, 'ETag: "1"\r\nContent-Length: 3\r\nX-A: old', body="one\r\n\r\n!"),
        record("response", "r2", "http://a.com/x", 5, 'ETag: "2"\r\nLast-Modified: L', body="two"),
        record("response", "r2b", "http://a.com/x", 5, 'ETag: "2b"', "\r\nWARC-Payload-Digest: d", body="tie"),
        record("revisit", "v1", "https://www.a.com/x/", 3, 'ETag: W/"1"\r\nX-A: new\r\nContent-Length: 0'),
        record("revisit", "v2", "http://a.com/x", 6, 'ETag: "2"'),
        record("revisit", "v3", "http://a.com/x", 1, 'ETag: "1"'),
        record("revisit", "v4", "http://a.com/x", 9, "Date: d"),
        record("revisit", "v5", "http://a.com/x", 9, "", "\r\nWARC-Payload-Digest: d"),
        record("revisit", "v6", "http://other.com/", 9, 'ETag: "1"'),
        record("revisit", "v7", "", 9, 'ETag: "1"'), record("revisit", "v1", "https://www.a.com/x/", 3, 'ETag: W/"1"'), None, "", "junk",
    ]
    records = parse_records(spark.createDataFrame([(x,) for x in raw], "raw string"))
    rows = resolve_revisits(records).collect()
    found = Counter((r.record_id, r.outcome, r.refers_to, r.body) for r in rows)
    assert found == Counter({
        ("v1", "resolved", "r1", "one\r\n\r\n!"): 2, ("v2", "mismatch", "r2b", None): 1, ("v3", "missing", None, None): 1,
        ("v4", "unvalidated", "r2b", None): 1, ("v5", "resolved", "r2b", "tie"): 1, ("v6", "missing", None, None): 1,
        ("v7", "missing", None, None): 1,
    })
    merged = [[tuple(h) for h in r.headers] for r in rows if r.record_id == "v1"]
    assert sorted(merged)[0] == [("content-length", "3"), ("etag", 'W/"1"'), ("x-a", "new")]
    assert resolve_revisits(records.limit(0)).count() == 0


def test_dates_and_profiles(spark):
    """Dates with fractions and of low precision, unreadable ones, and revisits that are not of the not-modified kind."""
    profile = "\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/"

    def dated(text, when):
        return re.sub(r"WARC-Date: \S+", f"WARC-Date: {when}", text, count=1)

    def full(text):
        return text.replace("304 Not Modified", "200 OK")

    tag = 'ETag: "1"'
    raw = [
        dated(record("response", "r1", "http://a.com/", 0, tag, body="one"), "2020-01-02T00:00:00.123456Z"),
        dated(record("response", "r0", "http://a.com/", 0, tag, body="never"), "garbage"),
        dated(record("revisit", "early", "http://a.com/", 0, tag), "2020-01-02T00:00:00.123455Z"),
        dated(record("revisit", "late", "http://a.com/", 0, tag), "2020-01-02T00:00:00.123457Z"),
        dated(record("revisit", "year", "http://a.com/", 0, tag), "2021"),
        dated(record("revisit", "unread", "http://a.com/", 0, tag), "garbage"),
        record("revisit", "named", "http://a.com/", 1, tag, profile + "server-not-modified"),
        full(record("revisit", "named200", "http://a.com/", 1, tag, profile + "server-not-modified")),
        full(record("revisit", "same", "http://a.com/", 1, tag, profile + "identical-payload-digest")),
        full(record("revisit", "plain200", "http://a.com/", 1, tag)),
    ]
    rows = resolve_revisits(parse_records(spark.createDataFrame([(x,) for x in raw], "raw string"))).collect()
    assert {r.record_id: (r.outcome, r.body) for r in rows} == {
        "early": ("missing", None), "late": ("resolved", "one"), "year": ("resolved", "one"), "unread": ("missing", None),
        "named": ("resolved", "one"), "named200": ("resolved", "one"), "same": ("other", None), "plain200": ("other", None),
    }


def test_unresolved_revisits_do_not_meet(spark, conf):
    """Rows that want no body are dealt out evenly before the last join."""
    raw = [record("response", f"r{i}", f"http://a.com/{i}", 1, 'ETag: "1"') for i in range(20)]
    raw += [record("revisit", f"v{i}", f"http://b.com/{i % 7}", 2, 'ETag: "1"') for i in range(800)]
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = resolve_revisits(parse_records(spark.createDataFrame([(x,) for x in raw], "raw string")))
    sizes = Counter(r.p for r in found.select(F.spark_partition_id().alias("p"), "body").collect())
    assert sum(sizes.values()) == 800 and max(sizes.values()) < 200


# --- segmentations ---------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def words():
    return vocabulary(file_bytes(f"{TOKENIZERS}/{segmentations.MODEL}"))


def draw(words, texts, seeds, k):
    made = []
    for block in blocks(pa.array(texts, pa.string()), 1 << 12):
        made += segmentations.segment_block(block, np.array(seeds, np.uint64)[block.first : block.first + block.rows], words, k).to_pylist()
    return made


def every_segmentation(words, text):
    """All id sequences of a text with their log probabilities."""
    lat = lattices(next(blocks(pa.array([text]))), words)
    found = [((), 0.0)]
    for t in lat.token:
        grown = []
        for ids, p in found:
            open_ = [(int(lat.start[t]), ids, p)]
            while open_:
                node, a, q = open_.pop()
                for e in range(lat.offset[node], lat.offset[node + 1]):
                    step = (int(lat.to[e]), (*a, int(lat.ids[e])), q + float(lat.log_p[e]))
                    grown.append(step[1:]) if step[0] < 0 else open_.append(step)
        found = grown
    return dict(found)


def test_round_trip(words):
    rng = random.Random(7)
    texts = ["", " ", "a", "  x\n\n y ", "▁ under", "<s> <0x41>", "\x00", "日本語 ☃ \U0001f600", "z" * 3000, "the quick  brown\tfox " * 50]
    texts += ["".join(rng.choice("ab é\n▁日 the") for _ in range(rng.randrange(80))) for _ in range(60)]
    for text, samples in zip(texts, draw(words, texts, range(len(texts)), 4)):
        assert len({tuple(s["ids"]) for s in samples}) == len(samples) >= 1
        assert all(segmentations.decode(s["ids"], words) == text for s in samples)
        keys = [s["key"] for s in samples]
        assert keys == sorted(keys, reverse=True) and all(s["log_inclusion"] <= 0 for s in samples)


def test_samples_follow_the_lattice(words):
    every = every_segmentation(words, "the cat")
    assert math.fsum(map(math.exp, every.values())) == pytest.approx(1)
    n, k = 6000, 2
    made = draw(words, ["the cat"] * n, range(n), k)
    for s in (s for samples in made[:50] for s in samples):
        assert s["log_prob"] == pytest.approx(every[tuple(s["ids"])])
    firsts = Counter(tuple(m[0]["ids"]) for m in made)
    pairs = Counter((tuple(m[0]["ids"]), tuple(m[1]["ids"])) for m in made)
    likely = sorted(every, key=every.get, reverse=True)[:6]
    for a in likely:
        p = math.exp(every[a])
        assert abs(firsts[a] - n * p) < 5 * math.sqrt(n * p) + 5
        for b in likely:
            if a != b:  # the second of a sample without replacement
                q = p * math.exp(every[b]) / (1 - p)
                assert abs(pairs[a, b] - n * q) < 5 * math.sqrt(n * q) + 5
    # inverse inclusion weights estimate the total probability
    total = [sum(math.exp(s["log_prob"] - s["log_inclusion"]) for s in m) for m in made]
    assert abs(np.mean(total) - 1) < 5 * np.std(total) / math.sqrt(n)


def test_few_segmentations(words):
    every = every_segmentation(words, "at")
    samples = draw(words, ["at"], [3], 50)[0]
    assert {tuple(s["ids"]) for s in samples} == set(every) and all(s["log_inclusion"] == 0 for s in samples)


def test_segmentation_frame(spark, edge, nothing):
    made = segmentations.sample_segmentations(edge.withColumn("samples", F.lit("mine")), 3)
    assert made.columns == [*edge.columns, "samples"]
    exploded = made.select("doc_id", "text", F.explode("samples.ids").alias("ids"))
    decoded = segmentations.decode_column(exploded, "ids", "decoded")
    assert decoded.filter("coalesce(text, '') != decoded").count() == 0 and decoded.select("doc_id", "text").distinct().count() == 7

    def drawn(frame):  # scores agree up to the last bits, which vary with a value's place in a vector operation
        return sorted(str((r.doc_id, [(s.ids, *(round(x, 9) for x in s[1:])) for s in r.samples])) for r in frame.collect())

    assert drawn(segmentations.sample_segmentations(edge.repartition(5), 3)) == drawn(made)
    assert segmentations.sample_segmentations(nothing).count() == 0
