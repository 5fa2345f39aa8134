"""TSV, JSON and model files. Absent values are empty strings, never null; NA is a string."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.operators.lookup import dedupe_last
from kinweave.sources.schema import CANDIDATES, SOURCE, TRUTH


@dataclass(frozen=True)
class Catalogue:
    """Where the relations are; a split has three sources and, for training, the truth."""

    root: str
    names: dict = field(default_factory=lambda: {f"{split}_{s}": f"{split}/{s}.tsv" for split in ("train", "test") for s in ("source1", "source2", "source3")} | {"train_truth": "train/ground_truth.tsv"})

    def path(self, name: str) -> str:
        return f"{self.root}/{self.names[name]}"


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All strings; empty and missing cells are ''. A missing file raises when the plan is made, another header when it is read."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("enforceSchema", False).option("escape", '"').csv(path).na.fill("")


def header(spark: SparkSession, path: str) -> list[str] | None:
    """The column names of a file, or None if there is no such file."""
    if not exists(spark, path):
        return None
    return spark.read.option("sep", "\t").option("header", True).option("escape", '"').csv(path).columns


def _on(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, which reaches every store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _on(spark, path)
    return fs.exists(at)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    fs, at = _on(spark, path)
    return fs.getContentSummary(at).getLength()


def with_row_ord(df: DataFrame) -> DataFrame:
    """df with row_ord, the rows' order from 0 on without gaps: a partition's rows follow those of all partitions before it."""
    marked = df.withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", 33)
    before = F.coalesce(F.sum("n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row a partition
    counts = marked.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).select("_part", before.alias("_before"))
    placed = marked.withColumn("_part", part).join(F.broadcast(counts), "_part")
    return placed.withColumn("row_ord", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_before", "_at")


def read_source(spark: SparkSession, path: str, src_ord: int) -> DataFrame:
    """A source with its place among the sources and its rows' order, which the caps need."""
    return with_row_ord(read_tsv(spark, path, SOURCE)).withColumn("src_ord", F.lit(src_ord))


def with_match_count(truth: DataFrame) -> DataFrame:
    """Commas count, trimmed or not: a trailing one adds an empty id."""
    cell = F.col("matched_entity_ids")
    return truth.withColumn("match_count", F.when(F.trim(cell) == "", 0).otherwise(F.size(F.split(cell, ","))))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return with_match_count(read_tsv(spark, path, TRUTH))


def read_all(spark: SparkSession, catalogue: Catalogue) -> dict[str, DataFrame]:
    """Every relation of the catalogue, lazily."""
    return {k: read_truth(spark, catalogue.path(k)) if k.endswith("truth") else read_source(spark, catalogue.path(k), int(k[-1]) - 1) for k in catalogue.names}


def split_ids(cell):
    """Trimmed ids of a comma list, without empty ones, each once, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(cell, ","), lambda x: F.trim(x)), lambda x: x != ""))


def parse_candidates(rows: DataFrame) -> DataFrame:
    """(source1_entity_id, pos, cand_id) of candidate rows; of an entity's rows the last by row_ord holds."""
    last = dedupe_last(rows, "source1_entity_id", "row_ord")
    return last.select("source1_entity_id", F.posexplode(split_ids(F.col("candidate_entity_ids"))).alias("pos", "cand_id"))


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    return parse_candidates(with_row_ord(read_tsv(spark, path, CANDIDATES)))


def write_tsv(df: DataFrame, path: str, order: str | None = None, keep: bool = False) -> None:
    """One file, sorted by `order` if given, a column that is written only if `keep`; empty cells stay empty."""
    out = df.repartition(1).sortWithinPartitions(order) if order else df.coalesce(1)
    out = out.drop(order) if order and not keep else out
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_json(value, path: str, spark: SparkSession) -> None:
    spark.createDataFrame([(json.dumps(value, indent=2, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str):
    return json.loads("".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
