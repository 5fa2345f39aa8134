"""Blocking recall, macro F0.5, the threshold sweep and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_entity(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    counts = pairs.groupBy("s1_id").agg(F.count("*").alias("n"))
    return s1.select(F.col("entity_id").alias("s1_id")).join(counts, "s1_id", "left").select("s1_id", F.coalesce("n", F.lit(0)).alias("n"))


def candidate_stats(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: entities, candidates in all, on average and at most, entities without one, and the size of the file."""
    n = F.col("n")
    out = _per_entity(s1, pairs).agg(F.count("*").alias("entities"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.avg("n").alias("average"), F.max("n").alias("most"), F.count_if(n == 0).alias("without"))
    return out.withColumns({"without_pct": F.when(F.col("entities") > 0, 100 * F.col("without") / F.col("entities")), "bytes": 12 * F.col("total") + 20 * F.col("entities")})


def blocking_recall(s1: DataFrame, pairs: DataFrame, true: DataFrame) -> DataFrame:
    """One row: how many true pairs, and entities with a true pair, the candidates hold. true: pairs of the truth."""
    found = true.join(pairs.select("s1_id", "cand_id", F.lit(1).alias("hit")), ["s1_id", "cand_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    by_entity = found.groupBy("s1_id").agg(F.count("*").alias("t"), F.sum("hit").alias("h"))
    recall = by_entity.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("true_pairs"), F.coalesce(F.sum("h"), F.lit(0)).alias("found_pairs"), F.count("*").alias("true_entities"), F.count_if(F.col("h") > 0).alias("found_entities"))
    stats = candidate_stats(s1, pairs).select("entities", "total", F.col("average").alias("avg_candidates"), F.col("without_pct").alias("zero_candidate_pct"))
    both = stats.withColumn("_k", F.lit(1)).join(recall.withColumn("_k", F.lit(1)), "_k").drop("_k")  # one row each
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return both.withColumns({"blocking_recall": part("found_pairs", "true_pairs"), "entity_recall": part("found_entities", "true_entities")})


def recall_ceiling(pairs: DataFrame, true: DataFrame) -> DataFrame:
    """One row: the share of the true pairs that the candidates hold, the most that any ranking can find; 0 without true pairs."""
    met = true.select("s1_id", "cand_id").join(pairs.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    out = met.agg(F.count("hit").alias("hits"), F.count("*").alias("total"))
    return out.withColumn("recall_ceiling", F.when(F.col("total") > 0, F.col("hits") / F.col("total")).otherwise(0.0))


def _f05(tp, n_pred, n_true) -> tuple:
    """(precision, recall, F0.5) of an entity's counts."""
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    pr, re = ratio(tp, n_pred), ratio(tp, n_true)
    return pr, re, F.when(pr + re > 0, 1.25 * pr * re / (0.25 * pr + re + 1e-12)).otherwise(0.0)


def macro_f05(entities: DataFrame, pred: DataFrame, true: DataFrame) -> DataFrame:
    """Mean precision, recall and F0.5 over entities (s1_id). An entity without truth and prediction counts 0."""
    t, p = true.select("s1_id", "cand_id", F.lit(1).alias("t")), pred.select("s1_id", "cand_id")
    tp = p.join(t, ["s1_id", "cand_id"], "left").groupBy("s1_id").agg(F.count("*").alias("np"), F.count("t").alias("tp"))
    nt = t.groupBy("s1_id").agg(F.count("*").alias("nt"))
    rows = entities.join(tp, "s1_id", "left").join(nt, "s1_id", "left").na.fill(0, ["np", "tp", "nt"])
    pr, re, f = _f05(F.col("tp"), F.col("np"), F.col("nt"))
    return rows.agg(F.avg(f).alias("macro_f05"), F.avg(pr).alias("macro_precision"), F.avg(re).alias("macro_recall"), F.count("*").alias("n_entities"))


def full_evaluation(entities: DataFrame, pred: DataFrame, pairs: DataFrame, true: DataFrame, threshold: float) -> DataFrame:
    """One row: macro_f05 with the recall ceiling of the candidates and the threshold."""
    scored, ceiling = macro_f05(entities, pred, true), recall_ceiling(pairs, true).select(F.col("recall_ceiling").alias("blocking_recall_ceiling"))
    both = scored.withColumn("_k", F.lit(1)).join(ceiling.withColumn("_k", F.lit(1)), "_k").drop("_k")  # one row each
    return both.withColumn("threshold", F.lit(float(threshold)))


def threshold_sweep(entities: DataFrame, scored: DataFrame, true: DataFrame) -> DataFrame:
    """macro_f05 at each threshold from 0.50 to 0.99.

    A pair counts up to the last step that its score reaches, so an entity needs its counts by last step
    (50 at most) and gives rows up to the highest of them alone; at all other steps it gives 0.
    """
    last = F.least(F.floor(F.col("score") * 100 + 1e-9).cast("int"), F.lit(99))
    hit = true.select("s1_id", "cand_id", F.lit(1).alias("t"))
    pred = scored.where("score >= 0.5").select("s1_id", "cand_id", last.alias("last")).join(hit, ["s1_id", "cand_id"], "left")
    by_last = pred.groupBy("s1_id", "last").agg(F.count("*").alias("np"), F.count("t").alias("tp"))
    lists = by_last.groupBy("s1_id").agg(F.collect_list(F.struct("last", "np", "tp")).alias("of"), F.max("last").alias("most"))
    nt = hit.groupBy("s1_id").agg(F.count("*").alias("nt"))
    rows = entities.join(lists, "s1_id").join(nt, "s1_id", "left").select("of", F.coalesce("nt", F.lit(0)).alias("nt"), F.explode(F.sequence(F.lit(50), F.col("most"))).alias("step"))
    total = lambda k: F.aggregate("of", F.lit(0).cast("long"), lambda a, x: a + F.when(x["last"] >= F.col("step"), x[k]).otherwise(0))
    counted = rows.select("step", "nt", total("np").alias("np"), total("tp").alias("tp"))
    pr, re, f = _f05(F.col("tp"), F.col("np"), F.col("nt"))
    sums = counted.groupBy("step").agg(F.sum(f).alias("f"), F.sum(pr).alias("p"), F.sum(re).alias("r"))
    steps = entities.agg(F.count("*").alias("n_entities")).withColumn("step", F.explode(F.sequence(F.lit(50), F.lit(99))))
    mean = lambda c: F.when(F.col("n_entities") > 0, F.coalesce(c, F.lit(0.0)) / F.col("n_entities"))
    out = steps.join(sums, "step", "left").select(mean(F.col("f")).alias("macro_f05"), mean(F.col("p")).alias("macro_precision"), mean(F.col("r")).alias("macro_recall"), "n_entities", (F.col("step") / 100).alias("threshold"))
    return out


def best_threshold(sweep: DataFrame, tolerance: float = 1e-6) -> tuple[float, float]:
    """(threshold, macro_f05) of the 50 rows of a sweep: the best, of about equal ones the highest."""
    best = (0.5, -1.0)
    for r in sorted(sweep.collect(), key=lambda r: r["threshold"]):
        if r["macro_f05"] > best[1] - tolerance:
            best = (r["threshold"], max(best[1], r["macro_f05"]))
    return best


def label_counts(rows: DataFrame) -> DataFrame:
    """One row: positive and negative pairs and the share of positive ones."""
    return rows.agg(F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("positive"), F.count_if(F.col("label") == 0).alias("negative"), F.avg("label").alias("positive_rate"))


def prediction_counts(matches: DataFrame, column: str = "matched") -> DataFrame:
    """One row: entities with a match, and links in all; matches: comma lists."""
    n = F.when(F.trim(column) == "", 0).otherwise(F.size(F.split(column, ",")))
    return matches.agg(F.count_if(n > 0).alias("entities_with_match"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("links"))


def match_buckets(counts: DataFrame, column: str = "match_count") -> DataFrame:
    """(bucket, n, pct): entities with no match, one, and more."""
    bucket = F.when(F.col(column) == 0, "0").when(F.col(column) == 1, "1").otherwise("2+")
    total = counts.agg(F.count("*").alias("all_rows"))
    grouped = counts.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    return grouped.withColumn("_k", F.lit(1)).join(F.broadcast(total.withColumn("_k", F.lit(1))), "_k").select("bucket", "n", (100 * F.col("n") / F.col("all_rows")).alias("pct"))
