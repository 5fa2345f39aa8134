"""The corpus pipeline: quality rules, toxicity, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, with the columns of
documents; the last returns where each piece of each document is packed. Each is written as Parquet and
read again as the next one's documents.

Null and empty texts have no words: quality rules reject them; a stage that is given one keeps it as it is,
and packing has no piece of it. Null doc_id: a document like others in every stage. Repeated rows: each is
judged by itself, one of them stays after near duplicates. Rows of one doc_id with other texts are documents
of their own. Ties: of near copies the smallest doc_id stays (null last), of several rows of it the smallest
text. Very long texts: whole. Columns beyond those of documents pass through all stages but the last, whatever
their names; n_chars is counted anew after repeated passages, if there is such a column. Empty table: no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.common import materialize, table
from kinweave.llm.jaccard import drop_similar
from kinweave.llm.packing import pack_documents
from kinweave.llm.quality import judge
from kinweave.llm.recompress import remove_repeats
from kinweave.llm.toxicity import score_documents, train, training_rows


def _carried(stage: Callable) -> Callable:
    """The stage over doc_id and text, with all other columns carried through it under names that no operator uses."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apart = {c: f"carried_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
        out = stage(spark, docs.select(*(F.col(f"`{c}`").alias(apart.get(c, c)) for c in docs.columns)), sf_dir)
        return out.select(*(F.col(apart.get(c, c)).alias(c) for c in docs.columns))

    return run


@_carried
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return judge(docs).where("kept")


@_carried
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scorer = train(training_rows(docs, table(spark, sf_dir, "labels")))
    return score_documents(docs, scorer).where("predicted = 0")


@_carried
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_similar(docs)


@_carried
def _without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = _without_repeats(spark, docs, sf_dir)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]
#: SQL can't express the fits and the packing; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
