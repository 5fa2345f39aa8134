"""Checks of a submission, each a DataFrame of offences (rule, s1_id, detail); passed if there are none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.sources.io import header

#: Cells that stand for nothing but aren't empty.
BLANKS = ("None", "null", "NaN", "[]", '""', "nan")


#: The columns of the files of a submission.
COLUMNS = {"matches": ("source1_entity_id", "matched_entity_ids"), "candidates": ("source1_entity_id", "candidate_entity_ids")}


def validate_files(spark: SparkSession, paths: Mapping[str, str], columns: Mapping[str, Sequence[str]] = COLUMNS) -> list[tuple[str, str, str]]:
    """(rule, "", detail) of files that are missing (V1) or have other columns (V2)."""
    out = []
    for name, path in paths.items():
        found = header(spark, path)
        if found is None:
            out.append((f"V1 no file {name}", "", path))
        elif tuple(found) != tuple(columns[name]):
            out.append((f"V2 columns {name}", "", ",".join(found)))
    return out


def _rows(df: DataFrame, rule: str, s1, detail) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), s1.cast("string").alias("s1_id"), detail.cast("string").alias("detail"))


def validate_submission(matches: DataFrame, candidates: DataFrame, s1: DataFrame, valid: DataFrame) -> DataFrame:
    """matches (s1_id, matched), candidates (s1_id, candidates): comma lists; s1, valid: entity_id of the test entities and of the other sources."""
    ids, ok = s1.select(F.col("entity_id").alias("s1_id")).distinct(), valid.select(F.col("entity_id").alias("id")).distinct()
    out = []
    for name, df in (("matches", matches), ("candidates", candidates)):
        counts = df.agg(F.count("*").alias("n")).withColumn("_k", F.lit(1)).join(ids.agg(F.count("*").alias("want")).withColumn("_k", F.lit(1)), "_k")
        out.append(_rows(counts.where("n <> want"), f"V3 rows {name}", F.lit(""), F.concat_ws(" of ", "n", "want")))
        out.append(_rows(df.groupBy("s1_id").count().where("count > 1"), f"V4 repeated {name}", F.col("s1_id"), F.col("count")))
        out.append(_rows(ids.join(df, "s1_id", "left_anti"), f"V5 missing {name}", F.col("s1_id"), F.lit("")))
        out.append(_rows(df.join(ids, "s1_id", "left_anti"), f"V5 unknown {name}", F.col("s1_id"), F.lit("")))
    given = lambda df, c: df.where(F.trim(c) != "").select("s1_id", F.explode(F.split(c, ",")).alias("id"))
    c, m = given(candidates, "candidates"), given(matches, "matched")
    out.append(_rows(matches.where(F.trim("matched").isin(*BLANKS)), "V9 blank", F.col("s1_id"), F.col("matched")))
    for rule, twice, df in (("V7", "V6", c), ("V11", "V10", m)):
        out.append(_rows(df.groupBy("s1_id", "id").count().where("count > 1"), f"{twice} repeated id", F.col("s1_id"), F.col("id")))
        out.append(_rows(df.join(ok, "id", "left_anti"), f"{rule} invalid id", F.col("s1_id"), F.col("id")))
        out.append(_rows(df.where(F.col("id").startswith("S1-")), f"{'V8' if rule == 'V7' else rule} own source", F.col("s1_id"), F.col("id")))
    out.append(_rows(m.join(c, ["s1_id", "id"], "left_anti"), "V12 not a candidate", F.col("s1_id"), F.col("id")))
    found = out[0]
    for x in out[1:]:
        found = found.unionByName(x)
    return found.distinct()


def submission_stats(matches: DataFrame) -> DataFrame:
    """One row: entities with no match, one, more, and matches on average."""
    n = F.when(F.trim("matched") == "", 0).otherwise(F.size(F.split("matched", ",")))
    return matches.select(n.alias("n")).agg(F.count_if(F.col("n") == 0).alias("none"), F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") > 1).alias("more"), F.avg("n").alias("average"))
