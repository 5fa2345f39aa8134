"""Each stage of the pipeline against a brute-force version, and documents of odd shapes through all of them."""

import random
from collections import Counter

import pytest
from brute import best_fit, brute_components, quality_of, shingles, without_repeats, words_of
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """name -> (rows before, rows after), each stage on what the one before kept."""
    import corpus_pipeline as p
    from kinweave.llm.common import materialize

    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), {}
    for name, stage in p.STAGES:
        done = materialize(stage(spark, docs, DIR))
        out[name] = docs, done
        docs = done
    return out


def test_columns(stages):
    for before, after in list(stages.values())[:-1]:
        assert after.columns == before.columns


def test_quality(spark, stages):
    from kinweave.llm import quality

    before, after = stages["quality_rules"]
    rows = quality.counts(before).collect()
    marked = [{**r.asDict(), "base_failed": r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]} for r in rows]
    chance = quality_of(marked)
    want = {r["doc_id"] for r in marked if not r["base_failed"] and chance(r) >= 0.5}
    assert {r["doc_id"] for r in after.collect()} == want and 0 < len(want) < len(rows)


def test_toxicity(spark, stages):
    import numpy as np

    from kinweave.llm import toxicity as X

    before, after = stages["toxicity"]
    scorer = X.train(X.training_rows(before, spark.read.parquet(f"{DIR}/labels.parquet")))

    def score(t):
        word = float(scorer.score(np.array([max(scorer.margins(sorted(set(X.units(t)))), default=scorer.bias)]))[0])
        return max(word, float(scorer.weigher.scores([t], {})[0]))

    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect() if score(r["text"]) < X.THRESHOLD}


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    sets = [(r["doc_id"], shingles(r["text"])) for r in before.collect()]
    _, groups = brute_components(sets)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(min(sets[i][0] for i in g) for g in groups.values())


def test_repeated_passages(stages):
    before, after = stages["substring_dedup"]
    rows = before.collect()
    want = {r["doc_id"]: x[2] for r, x in zip(rows, without_repeats([r["text"] for r in rows]), strict=True)}
    got = {r["doc_id"]: r for r in after.collect()}
    assert {k: r["text"] for k, r in got.items()} == want and all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_packing(stages):
    before, after = stages["best_fit_packing"]
    rows = after.collect()
    sizes = []
    for r in before.collect():
        n = len(words_of(r["text"]))
        sizes += [(min(4096, n - a), r["doc_id"], a) for a in range(0, n, 4096)]
    assert sorted((r["length"], r["doc_id"], r["start"]) for r in rows) == sorted(sizes)
    bins, _, final = best_fit(sorted((s for s, _, _ in sizes), reverse=True))
    assert Counter({r["bin"]: r["bin_length"] for r in rows}.values()) == Counter(dict(zip(bins, final, strict=True)).values())


def test_odd_documents(spark):
    """Nulls in every column, repeats, one id with two texts, a very long text, clashing names; then no documents at all."""
    import corpus_pipeline as p

    rng = random.Random(1)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))
    a, b = words(120), words(120)
    rows = [(1, a, "en", "x", len(a)), (1, b, "en", "x", len(b)), (1, a, None, None, None), (None, words(100), None, None, None), (None, a + " z", "en", "x", 5), (3, None, "en", "x", 0), (4, "", "en", "x", 0), (5, words(30_000), "en", "x", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ("kept", "quality", "n_words", "score", "predicted", "n_removed", "set_size", "label", "places", "row_hash")
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit(f"own {c}") for c in extra})
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        got = out.collect()
        assert out.columns == docs.columns and all(r[c] == f"own {c}" for r in got for c in extra), name
        none = stage(spark, docs.limit(0), DIR)
        assert none.columns == docs.columns and none.collect() == [], name
    kept = {(r["doc_id"], r["text"]) for r in p.STAGES[2][1](spark, docs, DIR).collect()}
    assert kept == {(1, a), (1, b), (None, rows[3][1]), (3, None), (4, ""), (5, rows[7][1])}
    assert p.STAGES[-1][1](spark, docs.limit(0), DIR).collect() == []
    lengths = Counter()
    for r in p.STAGES[-1][1](spark, docs, DIR).collect():
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {1: 360, None: 221, 5: 30_000}
