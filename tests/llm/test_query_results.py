"""Registered queries without SQL, held against plain Python, an exact round trip or labels no model has seen."""

import hashlib
import time
import tracemalloc
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from prodmart.llm import chat_windows as chat
from prodmart.llm.queries import QUALITY_LIMIT, QUERIES, SEGMENTATIONS, TOXICITY_LIMIT
from prodmart.llm.segmentations import decode_column

LARGER = "/root/testdata/sf0.1"  # the smaller tables have too few labels to tell


@pytest.mark.parametrize("name, label, limit, least", [
    ("op2_line_quality", "quality", QUALITY_LIMIT, 0.95), ("op5_toxicity", "toxic", TOXICITY_LIMIT, 0.97),
])
def test_scores_against_held_out_labels(spark, name, label, limit, least):
    """One score a document; of labelled documents that no fit has seen nearly all come out right, of either label."""
    docs = [r.doc_id for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id").collect()]
    rows = {r.doc_id: r for r in QUERIES[name](spark, LARGER).collect()}
    assert sorted(rows) == sorted(docs)
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").collect()
    unseen = [(rows[x.doc_id].predicted, x[label]) for x in labels if rows[x.doc_id].held_out]
    assert len(unseen) > 50 and sum(p == y for p, y in unseen) >= least * len(unseen)
    for y in (0, 1):
        own = [p for p, x in unseen if x == y]
        assert sum(p == y for p in own) >= 0.8 * len(own)


def test_chat_query(spark, sf_dir):
    """Digests of what was put in, by a plain walk over the turns."""
    said = "\\### Assistant: </turn> ok"
    turns = {}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    got = {r.conv_id: r for r in QUERIES["op7_chat_windows"](spark, sf_dir).collect()}
    assert set(got) == set(turns)
    for key, rows in turns.items():
        rows.sort()
        targets = "".join(text for _, role, text in rows if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        r = got[key]
        assert (r.n_turns, r.loss_chars) == (len(rows), len(targets))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(targets.encode()).hexdigest()
        assert r.formatted_chars >= sum(len(chat.format_turn(role, text)[0]) for _, role, text in rows)


def test_long_turns_are_read_back_in_little_memory():
    text = "<a> #\\ b" * 500_000  # four million characters
    written = chat.format_turn("user", text)[0]
    tracemalloc.start()
    start = time.perf_counter()
    assert chat.read_turns(written) == [("user", text)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * len(written) and time.perf_counter() - start < 30


def test_segmentations_query_decodes_to_the_texts(spark, sf_dir):
    """Every sample of every document spells the document; samples of one document differ and come by falling key."""
    made = QUERIES["op9_segmentations"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    each = made.select("doc_id", F.explode("samples").alias("s")).select("doc_id", "s.ids")
    decoded = decode_column(each, "ids", "decoded").drop("ids").join(docs, "doc_id")
    found = decoded.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.col("decoded") == F.col("text")).alias("same"))
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == docs.count() and all(r.same and r.n <= SEGMENTATIONS for r in rows.values())
    assert sum(r.n == SEGMENTATIONS for r in rows.values()) > 0.9 * len(rows)
    for r in made.collect():
        keys = [s["key"] for s in r.samples]
        assert keys == sorted(keys, reverse=True) and len({tuple(s["ids"]) for s in r.samples}) == len(keys)


@pytest.fixture
def edge_dir(spark, tmp_path, sf_dir):
    """Tables of a corpus of hard rows: nulls everywhere, repeated ids and rows, clashing names, long and empty texts."""
    def own(n):
        return " ".join(f"plain{n}x{i}" for i in range(40))

    rows = [
        (1, f"first {own(1)}", "a", "en"), (1, f"other {own(2)}", "a", "en"), (2, None, None, None),
        (None, f"nameless {own(3)}", "a", None), (None, f"second nameless {own(4)}", "b", "x"),
        (3, "", "a", "en"), (4, "long " + " ".join(f"w{i}" for i in range(40_000)), "a", "en"), (5, " \n\t ", "", ""),
        (6, "copy of the very same words again and again " + own(5), "a", "en"),
        (7, "copy of the very same words again and again " + own(5), "a", "en"),
        (7, "copy of the very same words again and again " + own(5), "a", "en"),
    ]
    names = "doc_id long, text string, source string, lang string"
    docs = spark.createDataFrame(rows, names).withColumns({c: F.lit("mine") for c in ("kept", "class_id", "toxicity", "samples", "_text")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_dir}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(None, None), ("1", ""), ("2", "unheard of words in no document at all")], "item_id string, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    return str(tmp_path)


def test_pipeline_of_edge_rows(spark, edge_dir):
    """Documents with a null id, and those that share one, are kept apart; of copies one stays."""
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    result = corpus_pipeline.run(spark, edge_dir)
    assert result.columns == [*(c for c in docs.columns if c != "samples"), "samples"]
    kept = sorted((str(r.doc_id), r.text[:8]) for r in result.collect())
    assert kept == [("1", "first pl"), ("1", "other pl"), ("4", "long w0 "), ("6", "copy of "), ("None", "nameless"), ("None", "second n")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, edge_dir).columns == docs.columns, name


def test_pipeline_of_empty_tables(spark, tmp_path, sf_dir):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
