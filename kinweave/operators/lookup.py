"""Unions, look-ups by id, and completion of outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedupe_last(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key."""
    last = W.partitionBy(key).orderBy(*(F.col(c).desc() for c in order))
    return df.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")


def union_sources(*sources: DataFrame) -> DataFrame:
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s)
    return out


def load_lookup(*sources: DataFrame) -> DataFrame:
    """The other sources as one, each id once: its last row in the last source that has it."""
    return dedupe_last(union_sources(*sources), "entity_id", "src_ord", "row_ord")


def last_wins(entities: DataFrame) -> DataFrame:
    """Entities with each id once on either side, the last row of it: ids of the first source, and those of the others together."""
    side = F.when(F.col("src_ord") == 0, 0).otherwise(1)
    last = W.partitionBy("entity_id", side).orderBy(F.col("src_ord").desc(), F.col("row_ord").desc())
    return entities.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")


def id_list(ids: Column) -> Column:
    """A comma list, each id once, sorted."""
    return F.array_join(F.array_sort(F.collect_set(ids)), ",")


def per_entity(s1: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Every entity of s1 with its candidates as a comma list, empty if it has none."""
    lists = pairs.groupBy("s1_id").agg(id_list(F.col("cand_id")).alias(name))
    return s1.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left").select("s1_id", F.coalesce(name, F.lit("")).alias(name))


def complete_submission(ids: DataFrame, predicted: DataFrame) -> DataFrame:
    """predicted (s1_id, matched, row_ord) for all ids, by id: of an entity's rows the last holds, none is an empty cell."""
    last = dedupe_last(predicted, "s1_id", "row_ord").select("s1_id", "matched")
    full = ids.select("s1_id").distinct().join(last, "s1_id", "full_outer").select("s1_id", F.coalesce("matched", F.lit("")).alias("matched"))
    return full.orderBy("s1_id")
