"""Quality rules under weak supervision, in DataFrame functions only.

Each rule looks at a document's counts and votes good (1), bad (-1) or abstains (0). Expectation
maximisation over the votes estimates how each rule votes on good and on bad documents, and a
document's posterior probability of being good decides, instead of a demand that all rules pass.
The fit needs only the number of documents of each vote pattern: at most 3 ** len(RULES) rows,
whatever the input, so it is summed on the executors and fitted on the driver.

Null text: no words, base_failed. Empty text: the same. Repeated rows: each is judged, alike. Ties at the
posterior of 0.5: kept. Very long texts: whole, a row at a time. Null doc_id: a document like others.
Extra columns pass through `judge`; its own columns replace those of the same name.
Empty table: no pattern, the starting accuracies stay, no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.common import WORD, fresh, materialize, table

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """Bind value once for body."""
    return F.transform(F.array(value), body)[0]


def _repeats(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more: sort the windows' hashes, keep the places of equal neighbours, add up what they cover."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i")))

    def covered(s: Column) -> Column:
        last = F.size(s) - 1
        twice = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | ((j < last) & (F.get(s, j + 1)["h"] == x["h"])))
        places = F.array_sort(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-3).alias("at"))
        step = lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(3), i - acc["at"])).cast("long").alias("sum"), i.alias("at"))
        return F.aggregate(places, zero, step, lambda acc: acc["sum"])

    distinct = F.size(F.array_distinct(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))))
    return F.when(n < 4, F.lit(0).cast("long")).when(distinct == n - 2, F.lit(0).cast("long")).otherwise(let(F.sort_array(windows), covered))


def counts(docs: DataFrame) -> DataFrame:
    """docs with the five counts, n_lines (lines with a word) and n_shouts ('!')."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    found = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"), _repeats(w).alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    of_words, of_lines = fresh(docs, "of_words"), fresh(docs, "of_lines")
    out = docs.withColumns({of_words: found, of_lines: by_line, "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"), "n_shouts": F.regexp_count(text, F.lit("!")).cast("long")})
    return out.withColumns({k: F.col(of_words)[k] for k in ("n_words", "word_chars", "n_repeat_words")} | {k: F.col(of_lines)[k] for k in ("n_lines", "n_dup_lines")}).drop(of_words, of_lines)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    n, per = F.col("n_words"), lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    mean = per("word_chars")
    return {
        "length": _vote(n >= 100, n < 50),
        "word_length": _vote(mean.between(3, 10), (mean < 2) | (mean > 14)),
        "symbols": _vote(per("n_symbols") < 0.05, per("n_symbols") > 0.2),
        "lines": _vote(F.col("n_dup_lines") == 0, lines > 0.3),
        "repeats": _vote(per("n_repeat_words") < 0.2, per("n_repeat_words") > 0.4),
        "shouts": _vote(per("n_shouts") < 0.05, per("n_shouts") > 0.3),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 100) -> dict:
    """EM over (votes, number of documents). Starts from rules that are right 8 times in 10, with pseudo-counts of the same shape, so that good stays good."""
    start = {1: {1: 0.6, 0: 0.25, -1: 0.15}, 0: {1: 0.15, 0: 0.25, -1: 0.6}}
    prior = 0.8
    p = [{y: dict(start[y]) for y in (0, 1)} for _ in range(n_rules)]
    total = sum(n for _, n in patterns)
    weight = max(5.0, 0.01 * total)
    for _ in range(rounds if total else 0):
        mass = [{y: {v: weight * start[y][v] for v in (1, 0, -1)} for y in (0, 1)} for _ in range(n_rules)]
        good = 0.0
        for votes, n in patterns:
            a = math.log(prior) + sum(math.log(p[k][1][v]) for k, v in enumerate(votes))
            b = math.log(1 - prior) + sum(math.log(p[k][0][v]) for k, v in enumerate(votes))
            q = 1 / (1 + math.exp(max(-700.0, min(700.0, b - a))))
            good += n * q
            for k, v in enumerate(votes):
                mass[k][1][v] += n * q
                mass[k][0][v] += n * (1 - q)
        was, prior = prior, min(0.99, max(0.01, (good + 0.8 * weight) / (total + weight)))
        p = [{y: {v: m / sum(mass[k][y].values()) for v, m in mass[k][y].items()} for y in (0, 1)} for k in range(n_rules)]
        if abs(was - prior) < 1e-9:
            break
    return {"prior": prior, "votes": p}


def posterior(model: dict, votes: list[Column]) -> Column:
    logit = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for p, vote in zip(model["votes"], votes, strict=True):
        by = {v: math.log(p[1][v] / p[0][v]) for v in (1, 0, -1)}
        logit = logit + F.when(vote == 1, by[1]).when(vote == -1, by[-1]).otherwise(by[0])
    return 1 / (1 + F.exp(-logit))


def judge_counts(counted: DataFrame, keep_at: float = 0.5) -> DataFrame:
    by_rule = rules()
    # Base failures are out whatever the rules say, and would teach them only what is known.
    # They are left out after the count: a filter before it would have the texts counted once more.
    seen = counted.groupBy(*(v.alias(k) for k, v in by_rule.items()), base_failed().alias("failed")).count().where("not failed").drop("failed").collect()
    model = fit(sorted((tuple(r)[:-1], r["count"]) for r in seen), len(by_rule))
    out = counted.withColumns({"base_failed": base_failed(), "quality": posterior(model, list(by_rule.values()))})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_at))


def judge(docs: DataFrame, keep_at: float = 0.5) -> DataFrame:
    """docs, all columns, with their counts, base_failed, quality (the posterior) and kept.

    Texts are counted for the fit and again for the verdict, rather than written once more. kept depends on a
    row number, which is never below 0, so that Spark doesn't move a filter by it below the counts and make them twice.
    """
    at = fresh(docs, "row_number")
    out = judge_counts(counts(docs).withColumn(at, F.monotonically_increasing_id()), keep_at)
    return out.withColumn("kept", F.col("kept") & (F.col(at) >= 0)).drop(at)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = counts(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    out = judge_counts(materialize(counted))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
