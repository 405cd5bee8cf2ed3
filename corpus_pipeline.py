"""Corpus pipeline: quality rules, toxicity, near duplicates, benchmark decontamination, segmentation.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; `run` writes every stage's result
below the shared folder and reads it again. Stages return the columns they got, the last one adds `samples`.
Null and empty texts, repeated rows, empty tables and further columns are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prodmart.llm import toxicity
from prodmart.llm.decontaminate import drop_contaminated
from prodmart.llm.frames import training_texts, written
from prodmart.llm.jaccard_join import keep_one
from prodmart.llm.quality_rules import keep_good
from prodmart.llm.segmentations import sample_segmentations

SEGMENTATIONS = 3

# Toxicity is a model fitted to labels and segmentation a random search, so no SQL gives these rows;
# tests hold the stages against brute force instead.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose host is rejected, go."""
    return keep_good(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The model is fitted to labelled rows of `documents` that are not held out."""
    known = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(training_texts(known, labels, "toxic", toxicity.Fit().sample))
    return toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies stays: the one with the least id."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its sampled segmentations."""
    return sample_segmentations(docs, SEGMENTATIONS)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("segment", segment),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
