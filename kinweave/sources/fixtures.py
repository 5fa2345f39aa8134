"""Entity relations made of the driver's tables: every row has one role by its number modulo 3, and no row or text is left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _entities(df: DataFrame, key: str, name, address, country) -> DataFrame:
    k = F.col(key) % 3
    return df.select(F.concat(F.lit("S"), (k + 1).cast("string"), F.lit("-"), F.lpad(F.col(key).cast("string"), 9, "0")).alias("entity_id"), name.alias("business_name"), address.alias("business_address"), F.coalesce(country, F.lit("")).alias("country"), k.cast("int").alias("src_ord"), F.col(key).alias("row_ord"))


def document_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name: a document's first line; address: all that follows; country: its language."""
    text = F.coalesce("text", F.lit(""))
    name = F.substring_index(text, "\n", 1)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", text.alias("text"))
    name = F.substring_index("text", "\n", 1)
    return _entities(docs, "doc_id", name, F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)"), F.col("lang"))


def part_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with a firm's form and addresses with a street's, so that the word tables have work."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    form = F.element_at(F.array(*map(F.lit, ("Ltd.", "Inc", "Co", "LLC"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    return _entities(part, "p_partkey", F.concat_ws(" ", "p_name", "p_type", form), F.concat_ws(" ", F.col("p_size").cast("string"), F.col("p_type"), F.lit("St."), F.lpad((F.col("p_partkey") % 97).cast("string"), 5, "5")), F.col("p_brand"))


def customer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that all begin alike, so that keys are cut to their cap."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return _entities(read("customer").join(F.broadcast(read("nation")), F.col("c_nationkey") == F.col("n_nationkey")), "c_custkey", F.col("c_name"), F.lit(""), F.col("n_name"))


def weak_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a name, so that address keys are used."""
    return document_entities(spark, sf_dir).withColumn("business_name", F.lit(""))


def truth(entities: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_entity_ids): the other sources' records of the same name and address."""
    s1 = entities.where("src_ord = 0")
    same = F.md5(F.concat_ws("\n", "business_name", "business_address"))
    others = entities.where("src_ord > 0").select(same.alias("h"), F.col("entity_id").alias("id"))
    met = s1.select("entity_id", same.alias("h")).join(others, "h", "left")
    return met.groupBy(F.col("entity_id").alias("source1_entity_id")).agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("matched_entity_ids"))
