"""Candidate generation: an equi-join on blocking keys with a cap a key and a cap an entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.sources.schema import MAX_BEFORE_CAP, MAX_PER_ENTITY, MAX_PER_KEY


def inverted_index(keys: DataFrame, probe: DataFrame | None = None, cap: int = MAX_PER_KEY) -> DataFrame:
    """(key, cand_id): of each key the first `cap` ids in ingest order.

    With probe keys, others are left out before the cap, which is a key's own, so the result is the
    same for the join. The cap is a window with a group limit, taken before the shuffle as well, so a
    key that most records share sends `cap` rows a task.
    """
    if probe is not None:
        keys = keys.join(probe.select("key").distinct(), "key", "left_semi")
    once = keys.groupBy("key", F.col("entity_id").alias("cand_id")).agg(F.min(F.struct("src_ord", "row_ord")).alias("at"))
    first = W.partitionBy("key").orderBy("at", "cand_id")
    return once.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= cap).select("key", "cand_id")


def hits(s1_keys: DataFrame, index: DataFrame) -> DataFrame:
    """(s1_id, cand_id, f): f is the first key by which a candidate was reached."""
    met = s1_keys.select(F.col("entity_id").alias("s1_id"), "ord", "key").join(index, "key")
    return met.groupBy("s1_id", "cand_id").agg(F.min("ord").alias("f"))


def candidate_pairs(s1_keys: DataFrame, index: DataFrame, cap: int = MAX_PER_ENTITY, before: int = MAX_BEFORE_CAP) -> DataFrame:
    """(s1_id, cand_id). Keys are read until `before` candidates are found, so a candidate stays if fewer
    came by earlier keys: rank() - 1 of them. The entity itself counts so far and is then left out; the
    `cap` smallest ids stay."""
    by_key = W.partitionBy("s1_id").orderBy("f")
    kept = hits(s1_keys, index).withColumn("r", F.rank().over(by_key)).where((F.col("r") <= before) & (F.col("cand_id") != F.col("s1_id")))
    by_id = W.partitionBy("s1_id").orderBy("cand_id")
    return kept.withColumn("rn", F.row_number().over(by_id)).where(F.col("rn") <= cap).select("s1_id", "cand_id")


def all_pairs(s1_keys: DataFrame, index: DataFrame) -> DataFrame:
    """The pairs of the ranking path, which has no cap an entity."""
    return hits(s1_keys, index).where("cand_id <> s1_id").select("s1_id", "cand_id")
