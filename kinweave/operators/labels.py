"""Truth, labels, sampling and the split of entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.sources.io import split_ids


def explode_truth(truth: DataFrame, trim: bool = True) -> DataFrame:
    """(s1_id, cand_id) of the truth, each pair once. Blocking's own evaluation splits without trimming and keeps empty ids."""
    cell = F.col("matched_entity_ids")
    ids = split_ids(cell) if trim else F.split(cell, ",")
    rows = truth if trim else truth.where(F.trim(cell) != "")
    return rows.select(F.col("source1_entity_id").alias("s1_id"), F.explode(ids).alias("cand_id")).distinct()


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label 1 if the truth has them, else 0."""
    true = explode_truth(truth).withColumn("_t", F.lit(1))
    return pairs.join(true, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("_t", F.lit(0))).drop("_t")


def _draw(*columns: str, seed: int):
    return F.md5(F.concat(F.lit(str(seed)), *(F.col(c) for c in columns)))


def sample_pairs(labelled: DataFrame, ratio: int = 5, seed: int = 42) -> DataFrame:
    """All positives, and at most `ratio` negatives for each of them, drawn by hash; entities without a positive are left out."""
    of = W.partitionBy("s1_id")
    ranked = labelled.withColumns({"pos": F.sum("label").over(of), "rn": F.row_number().over(W.partitionBy("s1_id", "label").orderBy(_draw("s1_id", "cand_id", seed=seed), "cand_id"))})
    return ranked.where((F.col("pos") > 0) & ((F.col("label") == 1) | (F.col("rn") <= ratio * F.col("pos")))).select("s1_id", "cand_id", "label")


def group_split(rows: DataFrame, percent: int = 20, seed: int = 42) -> DataFrame:
    """rows with is_val: all rows of an entity on one side."""
    h = F.conv(F.substring(F.md5(F.concat(F.col("s1_id"), F.lit(str(seed)))), 1, 8), 16, 10).cast("long")
    return rows.withColumn("is_val", h % 100 < percent)
