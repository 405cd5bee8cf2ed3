"""Registered queries of the llm operators agree with their SQL; the pipeline keeps what plain Python keeps."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from prodmart.llm import toxicity
from prodmart.llm.decontaminate import words
from prodmart.llm.frames import training_texts
from prodmart.llm.queries import ORACLE, QUERIES
from prodmart.llm.quality_rules import keep_good
from prodmart.llm.textscan import blocks
from test_text_operators import brute_classes


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = compare.open_tables(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, sf_dir, tables, name):
    df = QUERIES[name](spark, sf_dir)
    columns, rows = compare.spark_rows(df)
    expected_columns, expected, kinds = compare.duck_rows(tables, ORACLE[name])
    assert columns == expected_columns
    assert compare.type_mismatches(df, kinds) == []
    assert rows == expected




def test_near_duplicates_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    expected = brute_classes([d.text or "" for d in docs])  # by place, which grows with the id
    got = {r.doc_id: (r.class_id, r.n_links, r.copy_id) for r in QUERIES["op6_near_duplicates"](spark, sf_dir).collect()}
    ids = [d.doc_id for d in docs]
    assert len(got) == len(ids) and got == {ids[i]: (ids[c], n, ids[k]) for i, (c, n, k) in expected.items()}


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == [*docs.columns, "samples"]
    kept = {r.doc_id for r in result.select("doc_id").collect()}
    assert kept <= {r.doc_id for r in keep_good(docs).select("doc_id").collect()} and len(kept) > docs.count() / 2
    found = QUERIES["op1_decontamination"](spark, sf_dir).filter("contaminated")
    assert not kept & {r.doc_id for r in found.collect()}
    copies = docs.groupBy("text").agg(F.collect_list("doc_id").alias("ids")).filter("size(ids) > 1")
    assert all(len(kept & set(r.ids)) <= 1 for r in copies.collect())


def test_pipeline_keeps_every_good_document(spark, sf_dir):
    """The quality stage's rows and the fitted model are the operators' own; all else is plain Python."""
    docs, labels, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = toxicity.fit_toxicity(training_texts(docs.select("doc_id", "text"), labels, "toxic", toxicity.Fit().sample))
    rows = sorted((r.doc_id, r.text or "") for r in keep_good(docs).collect())
    score = np.concatenate([toxicity.score_block(b, model, 0.5)[0] for b in blocks(pa.array([t for _, t in rows]))])
    rows = [r for r, s in zip(rows, score) if s < 0.5]
    rows = [rows[i] for i in sorted({c for c, _, _ in brute_classes([t for _, t in rows]).values()})]
    grams = defaultdict(set)
    for item in bench.collect():
        w = words(item.text or "")
        n = min(10, len(w))
        grams[n] |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    expected = []
    for i, text in rows:
        w = words(text)
        if not any(tuple(w[k : k + n]) in known for n, known in grams.items() for k in range(len(w) - n + 1)):
            expected.append(i)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()) == expected
