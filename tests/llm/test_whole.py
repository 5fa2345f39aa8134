"""Cases in which an operator did less than its whole job."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"


def test_toxicity_of_all_languages(spark):
    from kinweave.llm import toxicity

    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").dropDuplicates(["doc_id"])
    got = toxicity.op5_toxicity(spark, d).where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").join(docs, "doc_id")
    rows = got.groupBy("lang").agg(F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("caught"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("wrong")).collect()
    assert {r["lang"] for r in rows} == {"de", "en", "es", "fr"}
    assert all(r["caught"] >= 0.8 and r["wrong"] <= 0.03 for r in rows), rows


def test_licenses_over_lines(spark):
    import textwrap

    from kinweave.llm import licenses

    around = ["Some words stand before it here.", "And others follow after."]
    texts, names = [], []
    for name, t in licenses.TEMPLATES.items():
        if len(licenses.words(t)) > 20:
            texts += ["\n".join([around[0], *textwrap.wrap(t, 60), around[1]]), f"{around[0]} {' '.join(t.split())} {around[1]}"]
            names += [name, name]
    texts += ["\n".join([around[0] * 30, "Released under the MIT License.", *textwrap.wrap(licenses.TEMPLATES["mit-grant"], 50), around[1] * 30])]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).orderBy("doc_id").collect()
    assert [(r["license"], r["dice"]) for r in got[:-1]] == [(x, 1.0) for x in names]
    assert all(r["n_notices"] == 1 for r in got[:-1])
    assert (got[-1]["dice"], got[-1]["n_notices"]) == (1.0, 2)


def test_search_ties_across_shards(spark, monkeypatch):
    """Copies in later shards, of smaller ids, win whatever way their score is rounded."""
    from kinweave.llm import common, search

    monkeypatch.setattr(search, "SHARD", 20)
    monkeypatch.setattr(search, "small_batches", lambda session: common.small_batches(session, 20))
    for n in range(1, 9):
        text = " ".join(f"w{i}" for i in range(n))
        rows = [(1000 - i, text + " filler" * (n % 3)) for i in range(60)] + [(2000 + i, f"other{i} w0") for i in range(20)]
        docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        got = search.search(docs, k=5, every=1000).where("query_id = 1000").orderBy("rank").collect()
        assert [r["doc_id"] for r in got] == [941, 942, 943, 944, 945]


def test_search_without_heads():
    """Terms that all stay below the least score are no error."""
    import numpy as np

    from kinweave.llm import search

    made = search.build_shard([7], [(np.array([5], np.uint64), np.array([1]), 1)])
    shard = search.Shard(*made.values(), 1.0)
    assert len(shard.search(np.array([0]), np.array([1.0]), 5, 100.0)[0]) == 0
    assert shard.search(np.array([0]), np.array([1.0]), 5, 0.0)[0].tolist() == [7]


def test_search_repeated_ids_and_nulls(spark, monkeypatch):
    """60 rows of one id are one answer; rows without an id count, but are no answer."""
    from kinweave.llm import search

    monkeypatch.setattr(search, "SHARD", 16)
    monkeypatch.setattr(search, "BLOCK", 4)
    rows = [(1000, "alpha beta")] + [(7, "alpha beta")] * 60 + [(100 + i, f"alpha x{i}") for i in range(20)] + [(None, "alpha beta")] * 20
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("score", "rank", "term", "shard", "part")}).coalesce(2)
    got = search.search(docs, k=10, every=1000).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [7, *range(100, 109)]


def test_search_blocks_of_random_texts(spark, monkeypatch):
    """Against brute force, over several shards, blocks of documents and blocks of queries."""
    import math
    import random
    from collections import Counter

    from kinweave.llm import search

    monkeypatch.setattr(search, "SHARD", 50)
    monkeypatch.setattr(search, "BLOCK", 8)
    monkeypatch.setattr(search, "QUERIES", 4)
    monkeypatch.setattr(search, "SAMPLED", 2)
    rng = random.Random(9)
    voc = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choices(voc, [1 / (i + 1) for i in range(200)], k=rng.randint(1, 60))) for _ in range(600)]
    bags = [Counter(t.split()) for t in texts]
    mean, df = sum(map(lambda b: b.total(), bags)) / 600, Counter(w for b in bags for w in b)

    def brute(q):
        out = []
        for d, b in enumerate(bags):
            s = sum(math.log1p((600 - df[t] + 0.5) / (df[t] + 0.5)) * b[t] * 2.2 / (b[t] + 1.2 * (0.25 + 0.75 * b.total() / mean)) for t in bags[q] if t in b)
            if d != q and s > 0:
                out.append((-round(s, 6), d))
        return [(d, -s) for s, d in sorted(out)[:10]]

    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)
    got = {}
    for r in search.search(docs).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    for q in range(0, 600, 50):
        assert [d for d, _ in got[q]] == [d for d, _ in brute(q)]
        assert all(abs(a[1] - b[1]) < 3e-6 for a, b in zip(got[q], brute(q), strict=True))


def test_toxicity_of_rare_insults():
    """A rare insult is found by its own counts, however frequent another one is."""
    import random

    from kinweave.llm import toxicity

    rng = random.Random(3)
    voc = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(4, 9))) for _ in range(400)]
    text = lambda *more: " ".join([*rng.choices(voc, k=40), *more])
    rows = [(text("zwqyxvk"), 1) for _ in range(500)] + [(text("jvxwqzy"), 1) for _ in range(40)] + [(text(), 0) for _ in range(540)]
    found = toxicity.toxic_stems(rows)
    assert any(x in "zwqyxvk" for x, _ in found) and any(x in "jvxwqzy" for x, _ in found)
    scorer = toxicity.train(rows)
    assert (scorer.score(scorer.margins(["zwqyxvk", "jvxwqzy"])) >= toxicity.THRESHOLD).all()


def test_toxicity_of_short_and_weak_words():
    """Insults of three letters, and common words that mark toxicity only together."""
    import random

    from kinweave.llm import toxicity

    rng = random.Random(4)
    voc = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(4, 9))) for _ in range(300)]
    weak = voc[:3]

    def rows(n):
        text = lambda *more: " ".join([*rng.choices(voc[3:], k=40), *more])
        for i in range(n):
            yield text("zqx"), 1
            yield text(*weak), 1
            yield text(*([weak[i % 3]] * (i % 2))), 0
            yield text(), 0

    scorer = toxicity.train(list(rows(150)))
    test = list(rows(50))
    got = scorer.weigher.scores([t for t, _ in test], {}) >= toxicity.THRESHOLD
    caught = [bool(g) for g, (_, y) in zip(got, test, strict=True) if y]
    wrong = [bool(g) for g, (_, y) in zip(got, test, strict=True) if not y]
    assert sum(caught) >= 0.9 * len(caught) and sum(wrong) <= 0.02 * len(wrong)
