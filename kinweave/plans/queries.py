"""The registered queries of the record-linkage engine: thin adapters over its operators."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.features import native_features, pair_features, pair_table
from kinweave.functions.keys import blocking_keys, tokens
from kinweave.functions.normalize import ADDRESS_WORDS, clean_country, clean_vectorized, normalize_entities
from kinweave.functions.similarity import similarities_udf
from kinweave.operators import blocking, labels, lookup, metrics, rank, validate
from kinweave.plans import flow, model
from kinweave.sources import fixtures
from kinweave.sources.io import parse_candidates, with_match_count

Q = {}


def query(f):
    Q[f.__name__] = f
    return f


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


class Data:
    """The relations that several queries use; each is a plan, made when it is asked for."""

    def __init__(self, spark, sf_dir, make=fixtures.document_entities, variant="vectorized", phonetic=True):
        self.raw, self.variant, self.phonetic = make(spark, sf_dir), variant, phonetic

    @functools.cached_property
    def ents(self):
        return normalize_entities(self.raw, self.variant).drop("business_name", "business_address", "country")

    @functools.cached_property
    def s1(self):
        return self.ents.where("src_ord = 0")

    @functools.cached_property
    def others(self):
        return self.ents.where("src_ord > 0")

    @functools.cached_property
    def keys(self):
        return blocking_keys(self.ents, self.phonetic)

    @functools.cached_property
    def s1_keys(self):
        return self.keys.where("src_ord = 0")

    @functools.cached_property
    def other_keys(self):
        return self.keys.where("src_ord > 0")

    @functools.cached_property
    def index(self):
        return blocking.inverted_index(self.other_keys)

    @functools.cached_property
    def pairs(self):
        return blocking.candidate_pairs(self.s1_keys, blocking.inverted_index(self.other_keys, self.s1_keys))

    @functools.cached_property
    def gt(self):
        return fixtures.truth(self.raw)

    @functools.cached_property
    def truth(self):
        return labels.explode_truth(self.gt)

    @functools.cached_property
    def ids(self):
        return self.s1.select(F.col("entity_id").alias("s1_id"))

    def overlap(self) -> DataFrame:
        """(s1_id, cand_id, score): Jaccard of the names' words, a score that SQL has as well."""
        side = lambda df, k, t: df.select(F.col("entity_id").alias(k), tokens(F.col("name_clean")).alias(t))
        both = self.pairs.join(side(self.s1, "s1_id", "x"), "s1_id").join(side(self.others, "cand_id", "y"), "cand_id")
        either = F.size(F.array_union("x", "y"))
        return both.select("s1_id", "cand_id", F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect("x", "y")) / either).alias("score"))

    def submission(self) -> DataFrame:
        return lookup.per_entity(self.s1, self.overlap().where("score >= 0.5"), "matched")


@query
def scan_entities(spark, d):
    return Data(spark, d).raw


@query
def gt_match_count(spark, d):
    return with_match_count(Data(spark, d).gt).select("source1_entity_id", F.col("match_count").cast("long").alias("match_count"))


@query
def parse_candidates_query(spark, d):
    x = Data(spark, d)
    cells = lookup.per_entity(x.s1, x.pairs, "candidate_entity_ids").withColumnRenamed("s1_id", "source1_entity_id")
    return parse_candidates(cells.withColumn("row_ord", F.lit(0)))


Q["parse_candidates"] = Q.pop("parse_candidates_query")
CLEAN = ("entity_id", "name_clean", "address_clean", "country_clean")
for _name, _make, _variant in (("normalize_entities", fixtures.document_entities, "vectorized"), ("normalize_scalar", fixtures.document_entities, "scalar"), ("normalize_parts", fixtures.part_entities, "vectorized")):
    Q[_name] = lambda spark, d, m=_make, v=_variant: Data(spark, d, m, v).ents.select(*CLEAN)
for _name, _make, _ph in (("blocking_keys", fixtures.document_entities, False), ("blocking_keys_phonetic", fixtures.document_entities, True), ("blocking_keys_weak", fixtures.weak_entities, True)):
    Q[_name] = lambda spark, d, m=_make, ph=_ph: Data(spark, d, m, phonetic=ph).keys.select("entity_id", "ord", "key")
Q["inverted_index"] = lambda spark, d: Data(spark, d).index
Q["inverted_index_hot"] = lambda spark, d: Data(spark, d, fixtures.customer_entities).index
Q["candidate_pairs"] = lambda spark, d: Data(spark, d).pairs
Q["candidate_pairs_hot"] = lambda spark, d: Data(spark, d, fixtures.customer_entities).pairs
Q["candidate_pairs_weak"] = lambda spark, d: Data(spark, d, fixtures.weak_entities).pairs


@query
def index_size(spark, d):
    return Data(spark, d).other_keys.agg(F.countDistinct("key").alias("n_keys"))


@query
def candidate_stats(spark, d):
    x = Data(spark, d)
    return rounded(metrics.candidate_stats(x.s1, x.pairs))


@query
def candidate_file(spark, d):
    x = Data(spark, d)
    return lookup.per_entity(x.s1, x.pairs, "candidates")


@query
def gt_explode(spark, d):
    return Data(spark, d).truth


@query
def gt_semi(spark, d):
    x = Data(spark, d)
    return x.gt.join(x.pairs.select(F.col("s1_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")


@query
def label_pairs(spark, d):
    x = Data(spark, d)
    return labels.label_pairs(x.pairs, x.gt)


@query
def sample_pairs(spark, d):
    x = Data(spark, d)
    return labels.sample_pairs(labels.label_pairs(x.pairs, x.gt))


@query
def group_split(spark, d):
    return labels.group_split(Data(spark, d).pairs)


@query
def pair_features_native(spark, d):
    x = Data(spark, d, fixtures.part_entities)
    return rounded(native_features(pair_table(x.pairs, x.s1, x.others)).drop("n_cands", *(f"{s}_{c}" for s in ("s1", "cand") for c in ("name", "addr", "country"))))


@query
def pair_features_full(spark, d):
    x = Data(spark, d, fixtures.part_entities)
    return pair_features(pair_table(x.pairs, x.s1, x.others))


@query
def block_and_rank_native(spark, d):
    x = Data(spark, d, fixtures.part_entities)
    return rounded(rank.rank_candidates(x.overlap()).select("s1_id", "cand_id", "rn", "score"))


@query
def block_and_rank(spark, d):
    return rounded(flow.block_and_rank(Data(spark, d, fixtures.part_entities, "scalar").ents).select("s1_id", "cand_id", "score", "rn", "matched"))


@query
def rank_score(spark, d):
    x = Data(spark, d, fixtures.part_entities, "scalar")
    return rounded(rank.score_pairs(x.pairs, x.s1, x.others))


@query
def topk_rank(spark, d):
    x = Data(spark, d, fixtures.part_entities, "scalar")
    return rounded(rank.rank_candidates(rank.score_pairs(x.pairs, x.s1, x.others)).select("s1_id", "cand_id", "rn", "score", "matched"))


@query
def pair_ratios(spark, d):
    """The ratios of names and addresses, as they stand and with their words sorted, from 0 to 1."""
    x = Data(spark, d, fixtures.part_entities)
    both = pair_table(x.pairs, x.s1, x.others).withColumns({"n": similarities_udf("s1_name", "cand_name"), "a": similarities_udf("s1_addr", "cand_addr")})
    return rounded(both.select("s1_id", "cand_id", *(F.col(f"{k[0]}.{f}").alias(f"{k}_{f}") for k in ("name", "addr") for f in ("ratio", "token_sort"))))


@query
def rank_summary(spark, d):
    x = Data(spark, d, fixtures.part_entities, "scalar")
    return rank.ranked_lists(x.s1, flow.block_and_rank(x.ents))


@query
def eda_shape(spark, d):
    return Data(spark, d).raw.groupBy("src_ord").agg(F.count("*").alias("n_rows"))


@query
def eda_country_counts(spark, d):
    return Data(spark, d).raw.groupBy("src_ord", "country").agg(F.count("*").alias("n"))


@query
def eda_country_nunique(spark, d):
    return Data(spark, d).raw.groupBy("src_ord").agg(F.countDistinct("country").alias("n"))


@query
def eda_match_buckets(spark, d):
    return rounded(metrics.match_buckets(with_match_count(Data(spark, d).gt)))


@query
def eda_match_breakdown(spark, d):
    return with_match_count(Data(spark, d).gt).where("match_count >= 2").groupBy(F.col("match_count").cast("long").alias("match_count")).agg(F.count("*").alias("n"))


@query
def blocking_recall(spark, d):
    x = Data(spark, d)
    out = metrics.blocking_recall(x.s1, x.pairs, labels.explode_truth(x.gt, trim=False))
    return rounded(out.select("true_pairs", "found_pairs", "true_entities", "found_entities", "blocking_recall", "entity_recall"))


@query
def macro_f05(spark, d):
    x = Data(spark, d)
    return rounded(metrics.macro_f05(x.ids, x.overlap().where("score >= 0.5"), x.truth))


@query
def threshold_sweep(spark, d):
    x = Data(spark, d)
    return rounded(metrics.threshold_sweep(x.ids, x.overlap(), x.truth))


@query
def recall_ceiling(spark, d):
    x = Data(spark, d)
    return rounded(metrics.recall_ceiling(x.pairs, x.truth))


@query
def full_evaluation(spark, d):
    """With the overlap of words as the score, which SQL has as well."""
    x = Data(spark, d)
    return rounded(metrics.full_evaluation(x.ids, x.overlap().where("score >= 0.5"), x.pairs, x.truth, 0.5))


@query
def label_counts(spark, d):
    x = Data(spark, d)
    return rounded(metrics.label_counts(labels.label_pairs(x.pairs, x.gt)))


@query
def prediction_counts(spark, d):
    return metrics.prediction_counts(Data(spark, d).submission())


@query
def candidate_lookup(spark, d):
    """The other sources with planted repeats of ids, of which the last holds."""
    raw = Data(spark, d).raw.select("entity_id", "country", "src_ord", "row_ord")
    again = raw.where("src_ord = 2 and row_ord % 5 = 0").select(F.concat(F.lit("S2-"), F.lpad((F.col("row_ord") - 1).cast("string"), 9, "0")).alias("entity_id"), F.lit("again").alias("country"), "src_ord", "row_ord")
    return lookup.load_lookup(raw.where("src_ord = 1"), raw.where("src_ord = 2"), again)


@query
def normalize_country(spark, d):
    return Data(spark, d).raw.select("entity_id", clean_country(F.concat(F.lit("\t "), F.upper("country"), F.lit(" \n"))).alias("country_clean"))


@query
def normalize_vectorized(spark, d):
    """The whole text as an address."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", clean_vectorized(F.col("text"), ADDRESS_WORDS).alias("clean"))


@query
def submission_stats(spark, d):
    return rounded(validate.submission_stats(Data(spark, d).submission()))


@query
def complete_submission(spark, d):
    x = Data(spark, d)
    return lookup.complete_submission(x.ids, x.submission().where("matched <> ''").withColumn("row_ord", F.lit(0)))


@query
def validate_submission(spark, d):
    """A submission with planted faults: blanks, and ids of the own source."""
    x = Data(spark, d)
    bad = F.when(F.col("s1_id").endswith("7"), "NaN").when(F.col("s1_id").endswith("8"), F.concat("matched", F.lit(",S1-000000000"))).otherwise(F.col("matched"))
    return validate.validate_submission(x.submission().withColumn("matched", bad), lookup.per_entity(x.s1, x.pairs, "candidates"), x.s1, x.others)


@query
def union_sources(spark, d):
    x = Data(spark, d)
    return lookup.union_sources(x.raw.where("src_ord = 1"), x.raw.where("src_ord = 2")).select("entity_id", "src_ord")


@query
def dedupe_last(spark, d):
    return lookup.dedupe_last(spark.read.parquet(f"{d}/events.parquet"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


@query
def predict_links(spark, d):
    """Trains on the sampled pairs and scores all candidates; records are normalised once, pairs made once."""
    x = Data(spark, d)
    x.ents = flow.held(x.ents)
    x.pairs = flow.held(x.pairs)
    made = model.train(flow.held(flow.sampled_features(x.ents, x.pairs, x.gt)))
    return model.predict(made, flow.all_features(x.ents, x.pairs, made))
