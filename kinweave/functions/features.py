"""The 47 features of a pair of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.keys import tokens
from kinweave.functions.similarity import address_edits_udf, name_edits_udf

#: Feature names in model order.
FEATURES = (
    "name_exact", "name_jw", "name_lev", "name_ratio", "name_partial", "name_token_sort", "name_token_set", "name_jaccard",
    "name_containment", "name_shared_tokens", "name_first_token_match", "name_last_token_match", "name_prefix4_match", "name_len_diff",
    "name_len_ratio", "name_digit_jaccard", "addr_exact", "addr_jw", "addr_lev", "addr_ratio", "addr_token_sort", "addr_token_set",
    "addr_jaccard", "addr_containment", "addr_shared_tokens", "addr_len_diff", "addr_len_ratio", "addr_digit_jaccard",
    "addr_housenum_match", "addr_pin_match", "country_exact", "country_conflict", "country_both_present", "country_s1_missing",
    "country_cand_missing", "cand_is_s2", "cand_is_s3", "n_candidates_for_s1", "name_x_addr", "name_plus_addr", "min_name_addr",
    "max_name_addr", "same_country_high_name", "same_country_high_addr", "exact_name_exact_country", "exact_addr_exact_country",
    "high_name_and_high_addr",
)
HIGH = 0.85
#: What is compared of addresses besides their words.
PATTERNS = {"housenum": r"\b(\p{Nd}+[a-zA-Z]?)\b", "pin": r"\b(\p{Nd}{5,6})\b"}


def _flag(c: Column) -> Column:
    return c.cast("double")


def _equal(a: Column, b: Column) -> Column:
    return F.coalesce(_flag((a != "") & (a == b)), F.lit(0.0))


def _sets(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """(Jaccard, containment of a in b, shared) of two arrays as sets."""
    both, either, first = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)), F.size(F.array_distinct(a))
    return (
        F.when(either == 0, 1.0).otherwise(both / either),
        F.when(first == 0, F.when(F.size(b) == 0, 1.0).otherwise(0.0)).otherwise(both / first),
        both.cast("double"),
    )


def _digits(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(\p{Nd}+)"), F.lit(1)))


def first_match(c: Column, pattern: str) -> Column:
    return F.lower(F.regexp_extract(c, pattern, 1))


def _native(side: str, a: Column, b: Column, distance: Column) -> dict[str, Column]:
    la, lb = F.length(a), F.length(b)
    jaccard, containment, shared = _sets(tokens(a), tokens(b))
    most = F.greatest(la, lb)
    out = {
        f"{side}_exact": _equal(a, b),
        f"{side}_lev": F.when(most == 0, 1.0).otherwise(1 - distance / most),
        f"{side}_jaccard": jaccard,
        f"{side}_containment": containment,
        f"{side}_shared_tokens": shared,
        f"{side}_len_diff": F.abs(la - lb).cast("double"),
        f"{side}_len_ratio": F.least(la, lb) / F.greatest(most, F.lit(1)),
        f"{side}_digit_jaccard": _sets(_digits(a), _digits(b))[0],
    }
    if side == "name":
        end = lambda c, i: F.coalesce(F.try_element_at(tokens(c), F.lit(i)), F.lit(""))
        out |= {
            "name_first_token_match": _equal(end(a, 1), end(b, 1)),
            "name_last_token_match": _equal(end(a, -1), end(b, -1)),
            "name_prefix4_match": _equal(F.substring(a, 1, 4), F.substring(b, 1, 4)),
        }
    else:
        out |= {f"addr_{k}_match": _equal(first_match(a, p), first_match(b, p)) for k, p in PATTERNS.items()}
    return out


def country_features() -> dict[str, Column]:
    """What countries, ids and the number of candidates tell."""
    c = F.col
    s1, s2 = c("s1_country"), c("cand_country")
    return {
        "country_exact": _equal(s1, s2),
        "country_conflict": _flag((s1 != "") & (s2 != "") & (s1 != s2)),
        "country_both_present": _flag((s1 != "") & (s2 != "")),
        "country_s1_missing": _flag(s1 == ""),
        "country_cand_missing": _flag(s2 == ""),
        "cand_is_s2": _flag(c("cand_id").startswith("S2-")),
        "cand_is_s3": _flag(c("cand_id").startswith("S3-")),
        "n_candidates_for_s1": c("n_cands").cast("double"),
    }


def native_features(pairs: DataFrame, distances: dict[str, Column] | None = None) -> DataFrame:
    """All features but the edit similarities; pairs as made by pair_table. distances: edit distances by side, if they are there."""
    c = F.col
    sides = {side: (c(f"s1_{side}"), c(f"cand_{side}")) for side in ("name", "addr")}
    native = {side: _native(side, a, b, distances[side] if distances else F.levenshtein(a, b)) for side, (a, b) in sides.items()}
    return pairs.withColumns(native["name"] | native["addr"] | country_features())


def pair_features(pairs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(s1_id, cand_id, extra columns, 47 floats). Thresholds are taken before the cast to float."""
    c = F.col
    out = pairs.withColumns({"_n": name_edits_udf("s1_name", "cand_name"), "_a": address_edits_udf("s1_addr", "cand_addr")})
    out = native_features(out, {"name": c("_n.distance"), "addr": c("_a.distance")})
    out = out.withColumns({f"{side}_{f}": c(f"_{side[0]}.{k}") for side in ("name", "addr") for f, k in (("jw", "w"), ("ratio", "ratio"), ("token_sort", "token_sort"), ("token_set", "token_set"))} | {"name_partial": c("_n.partial")})
    n, a = c("name_jw"), c("addr_jw")
    same = c("country_exact") == 1
    out = out.withColumns({
        "name_x_addr": n * a, "name_plus_addr": n + a, "min_name_addr": F.least(n, a), "max_name_addr": F.greatest(n, a),
        "same_country_high_name": _flag(same & (n >= HIGH)), "same_country_high_addr": _flag(same & (a >= HIGH)),
        "exact_name_exact_country": _flag(same & (c("name_exact") == 1)), "exact_addr_exact_country": _flag(same & (c("addr_exact") == 1)),
        "high_name_and_high_addr": _flag((n >= HIGH) & (a >= HIGH)),
    })
    clean = lambda f: F.when(F.isnan(f) | F.col(f).isNull() | (F.abs(F.col(f)) == float("inf")), 0.0).otherwise(F.col(f)).cast("float").alias(f)
    return out.select("s1_id", "cand_id", *extra, *(clean(f) for f in FEATURES))


def counted(pairs: DataFrame) -> DataFrame:
    return pairs.join(pairs.groupBy("s1_id").agg(F.count("*").alias("n_cands")), "s1_id")


def pair_table(pairs: DataFrame, s1: DataFrame, lookup: DataFrame) -> DataFrame:
    """pairs (s1_id, cand_id) with both records' clean texts; n_cands, if it isn't there, counts an entity's pairs before unknown ids are dropped.

    The shuffle of the last join has a fixed number of parts: what follows works long on few bytes, so parts aren't to be merged by size.
    """
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs if "n_cands" in pairs.columns else counted(pairs)
    side = lambda df, k: df.select(F.col("entity_id").alias(f"{k}_id"), F.col("name_clean").alias(f"{k}_name"), F.col("address_clean").alias(f"{k}_addr"), F.col("country_clean").alias(f"{k}_country"))
    return pairs.join(side(s1, "s1"), "s1_id").repartition(parts, "cand_id").join(side(lookup, "cand"), "cand_id")
