"""Nulls, repeats, ties, empty tables, very long texts and columns of clashing names, operator by operator."""

import random
from collections import Counter

import pytest
from brute import best_fit, brute_components, quality_of, shingles, without_repeats
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(rng, n, voc=400):
    return " ".join(f"w{rng.randint(0, voc)}" for _ in range(n))


# ---- op1 ------------------------------------------------------------------------------------------


def test_bpe_reuse_beyond_the_dictionary(spark, monkeypatch):
    """Shared chunks outside of the dictionary are reused as well, and what is evicted is encoded anew."""
    from kinweave.llm import bpe

    monkeypatch.setattr(bpe, "DICT_ENTRIES", 2)
    monkeypatch.setattr(bpe, "HELD", 3)
    rng = random.Random(4)
    shared = [words(rng, 900) for _ in range(6)]
    rows = [(i, " ".join([words(rng, 50), *rng.sample(shared, 3), words(rng, 20), "  \n x"])) for i in range(30)] + [(None, shared[0]), (None, None), (7, ""), (7, "again")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    lib = bpe.vocabulary(bpe.default_tokenizer())[0]
    got = sorted((str(r["doc_id"]), r["ids"]) for r in bpe.encode_documents(docs).collect())
    assert got == sorted((str(d), lib.encode(t or "", add_special_tokens=False).ids) for d, t in rows)


def test_bpe_seams(spark):
    """Where pieces of a seam don't agree, the text is encoded whole."""
    import numpy as np

    from kinweave.llm import bpe
    from kinweave.llm.common import Block

    rng = random.Random(5)
    path = bpe.default_tokenizer()
    text = words(rng, 2000).encode()
    block = Block(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    chunks, a = [], 0
    for b in bpe.chunk_ends(block)[0]:
        chunks.append(text[a:b])
        a = b
    import xxhash

    held = {xxhash.xxh3_64_intdigest(c) - 2**63: bpe.encode_chunk(path, c) for c in chunks if len(c) >= bpe.LEAST}
    reuse = bpe.Reuse(path, held, np.full(1 << 20, 255, np.uint8))
    want = bpe.plain_ids(path, text)
    parts, names = next(bpe.encode_block(path, block, reuse))
    assert [x for p in parts for x in p] == want and any(isinstance(n, tuple) for n in names)
    agrees = bpe.agrees
    bpe.agrees = lambda *a: False
    try:
        parts, names = next(bpe.encode_block(path, block, reuse))
    finally:
        bpe.agrees = agrees
    assert parts == [want] and names == [None]


# ---- op2 ------------------------------------------------------------------------------------------


def test_language_cases(spark, empty):
    import numpy as np

    from kinweave.llm import language

    rng = random.Random(1)
    alphabets = {"en": "abcdefgh", "de": "ijklmnop", "fr": "qrstuvwx", "es": "yzabijqr"}
    text = lambda k, n: " ".join("".join(rng.choice(alphabets[k]) for _ in range(5)) for _ in range(n))
    rows = [(i, text(k, 40), k) for i, k in enumerate(list(alphabets) * 60)]
    docs = spark.createDataFrame([*rows, (None, text("en", 5), "en"), (3, None, "en"), (rows[0])], "doc_id long, text string, lang string").withColumns({"has_letter": F.lit("own"), "_letter": F.lit("own")})
    model = language.train(language.training_rows(docs))
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows) + 3 and all(r["has_letter"] == r["_letter"] == "own" for r in got)
    known = [r for r in got if r["text"]]
    assert sum(r["lang"] == r["lang_pred"] for r in known) > 0.97 * len(known)
    assert language.identify(empty, model).collect() == [] and language.training_rows(empty.withColumn("lang", F.lit("en"))) == []
    # Votes by hand: the family's pairs first, then the pairs within it.
    import pyarrow as pa

    texts = [r[1] for r in rows[:20]] + [text("fr", 20_000)]
    x = language.features(pa.array(texts))
    margins = x.astype(float) @ model.weights.astype(float) + model.biases
    assert np.allclose(margins, model.margins(pa.array(texts)), atol=1e-4)
    names, scores = model.predict(pa.array(texts))
    for row, name, score in zip(margins, names, scores, strict=True):
        at = {p: i for i, p in enumerate(model.pairs)}

        def winner(level, of, row=row, at=at):
            votes = Counter(of)
            total = Counter()
            for (group, a, b), i in at.items():
                if group == level:
                    votes[a if row[i] >= 0 else b] += 1
                    total[a] += row[i]
                    total[b] -= row[i]
            return max(of, key=lambda y: (votes[y], total[y]))

        f = winner("family", model.families)
        assert name == winner(f, [y for y in model.languages if language.family(y) == f]) and 0 <= score <= 1


# ---- op4 ------------------------------------------------------------------------------------------


def test_license_cases(spark, empty):
    import textwrap

    from kinweave.llm import licenses

    rng = random.Random(2)
    filler = "\n".join(words(rng, 12) for _ in range(40))
    wrapped = lambda name, mark: "\n".join(mark + x for x in textwrap.wrap(licenses.TEMPLATES[name], 72))
    rows = [(i, f"{wrapped(n, m)}\n{filler}") for i, (n, m) in enumerate([(n, m) for n in ("gpl-3.0-header", "mit-grant", "apache-2.0-header") for m in ("", " * ", "# ", "// ")])]
    rows += [(None, None), (50, ""), (50, "x"), (90, words(rng, 150_000) + "\nReleased under the MIT License.")]
    got = licenses.scan(spark.createDataFrame(rows, SCHEMA).withColumn("license", F.lit("own"))).collect()
    by = {r["doc_id"]: (r["license"], r["dice"]) for r in got if r["text"] and r["doc_id"] != 50}
    for i, (n, _) in enumerate([(n, m) for n in ("gpl-3.0-header", "mit-grant", "apache-2.0-header") for m in range(4)]):
        assert by[i] == (n, 1.0)
    assert by[90] == ("mit", 1.0) and [(r["license"], r["dice"]) for r in got if not r["text"]] == [(None, 0.0)] * 2
    assert licenses.scan(empty).collect() == []


# ---- op5 ------------------------------------------------------------------------------------------


INSULTS = ("idiot", "stupid", "moron", "worthless", "zwqyxvk")


@pytest.fixture(scope="module")
def scorer():
    from kinweave.llm import toxicity

    rng = random.Random(3)
    voc = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(4, 9))) for _ in range(6000)]
    text = lambda *more: " ".join([*rng.choices(voc, k=40), *more, *rng.choices(voc, k=20)]) + "."
    made = toxicity.train([(text(rng.choice(INSULTS)), 1) for _ in range(400)] + [(text(), 0) for _ in range(400)])
    made.clean = [text() for _ in range(300)]
    return made


def test_toxicity_of_inserted_characters(scorer):
    """One mark, two marks and a mark in every place of an insult; one letter within it."""
    from kinweave.llm import toxicity

    toxic = lambda w: (scorer.score(scorer.margins(toxicity.units(w))) >= toxicity.THRESHOLD).any()
    assert sum(toxic(t) for t in scorer.clean) <= 3
    for w in INSULTS:
        for mark in ".-*_":
            assert toxic(mark.join(w)) and toxic((2 * mark).join(w))
            for i in range(1, len(w)):
                assert toxic(w[:i] + mark + w[i:]) and toxic(w[:i] + 2 * mark + w[i:])
        assert toxic(" ".join(w)) and toxic(w.upper() + "!!") and toxic(f'"{w}",')
    letters = [w[:i] + "x" + w[i:] for w in INSULTS for i in range(1, len(w))]
    assert sum(map(toxic, letters)) >= 0.8 * len(letters)


def test_toxicity_kernel_against_plain_sums(scorer):
    """K(word, landmark): over common subsequences, the best weight in either, over the landmark's norm."""
    import itertools
    import math

    from kinweave.llm import toxicity as X

    def weights(w):
        out = {}
        for p in itertools.combinations(range(len(w)), X.LENGTH):
            s = "".join(w[i] for i in p)
            out[s] = max(out.get(s, 0), X.DECAY ** (p[-1] - p[0] + 1))
        return out

    rng = random.Random(9)
    made = ["".join(rng.choice("idotsupmrnwhlezqyxvk") for _ in range(rng.randint(4, 12))) for _ in range(200)] + list(INSULTS)
    got = scorer.kernels(made)
    near = scorer.near(X.letter_bits(made))
    for i, w in enumerate(made):
        a = weights(w)
        for k, landmark in enumerate(scorer.landmarks):
            b = weights(landmark)
            want = sum(a[s] * b[s] for s in a.keys() & b.keys()) / math.sqrt(sum(x * x for x in b.values()))
            assert abs(got[i, k] - want) < 1e-9 and (near[i] or want == 0)


def test_toxicity_cases(spark, scorer, empty):
    """Scores row by row against the scorer itself; nulls, empty and very long texts, repeats, ties, clashing names."""
    import numpy as np

    from kinweave.llm import toxicity as X

    long = " ".join(scorer.clean * 4)
    rows = [(i, t) for i, t in enumerate(scorer.clean[:20])] + [(100, scorer.clean[0] + " you idiot"), (None, None), (5, ""), (5, " .. "), (None, long), (None, long + " moron"), (100, scorer.clean[0] + " you idiot")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit("own"), "predicted": F.lit("own"), "seen": F.lit("own")}).repartition(3)
    got = X.score_documents(docs, scorer).collect()

    def brute(t):
        units = sorted(set(X.units(t or "")))
        word = float(scorer.score(np.array([max(scorer.margins(units), default=scorer.bias)]))[0])
        return max(word, float(scorer.weigher.scores([t], {})[0]))

    want = sorted((str(d), t or "", round(brute(t), 9)) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["text"] or "", round(r["score"], 9)) for r in got) == want
    assert all(r["seen"] == "own" and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= X.THRESHOLD) for r in got)
    assert {r["predicted"] for r in got if "idiot" in (r["text"] or "") or "moron" in (r["text"] or "")} == {1}
    assert X.score_documents(empty, scorer).collect() == []


# ---- op6 ------------------------------------------------------------------------------------------


def test_quality_posterior_against_plain_em(spark, empty):
    """kept and quality against expectation maximisation over documents, one by one."""
    from kinweave.llm import quality

    rng = random.Random(3)
    rows = [(i, " ".join([words(rng, rng.randint(60, 300)), "!" * rng.choice([0, 0, 40, 200]), "# " * rng.choice([0, 0, 5, 90])]) + "\nsame line here\n" * rng.choice([0, 0, 3, 30])) for i in range(150)]
    rows += [(None, rows[0][1]), (3, None), (3, ""), rows[5], (None, words(rng, 60_000))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"of_words": F.lit("own"), "of_lines": F.lit("own"), "_w": F.lit("own")})
    got = quality.judge(docs).collect()
    assert len(got) == len(rows) and all(r["of_words"] == r["of_lines"] == r["_w"] == "own" for r in got)

    chance = quality_of(got)
    for r in got:
        assert abs(r["quality"] - chance(r)) < 1e-6
        assert r["kept"] == (not r["base_failed"] and chance(r) >= 0.5)
    assert quality.judge(empty).collect() == []


# ---- op7 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("part", [512, 4])
def test_jaccard_repeated_and_null_ids(spark, monkeypatch, part):
    from kinweave.llm import jaccard

    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard, "HOT", 3 if part == 4 else 2000)
    rng = random.Random(7)
    a, b = words(rng, 60), words(rng, 60)
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (None, a + " z"), (None, words(rng, 40)), (None, None), (9, ""), (9, "one two")]
    base = [words(rng, 40, 30) for _ in range(4)]
    for i in range(60):  # chains of near copies, whose members share keys across components
        w = base[i % 4].split()
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(40)] = f"w{rng.randint(0, 30)}"
        rows.append((100 + i // 2 if i % 3 else None, " ".join(w)))
    rows.append(rows[2])
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("label", F.lit("own")).repartition(3)
    sets = [(d, shingles(t)) for d, t in rows]
    want, groups = brute_components(sets)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(docs).collect())
    assert got == Counter((d, len(s), want[i]) for i, (d, s) in enumerate(sets))
    kept = jaccard.drop_similar(docs.withColumns({"set_size": F.lit(1), "kept_id": F.lit(2)}))
    assert kept.columns == [*docs.columns, "set_size", "kept_id"]
    first = []
    for members in groups.values():
        if not sets[members[0]][1]:
            first += [rows[i][0] for i in members]
            continue
        first.append(min((rows[i][0] for i in members if rows[i][0] is not None), default=None))
    assert sorted(map(str, first)) == sorted(str(r["doc_id"]) for r in kept.collect())


def test_jaccard_orders_never_lose_a_link():
    import numpy as np

    from kinweave.llm import jaccard

    rng = np.random.Generator(np.random.PCG64(1))
    met = 0
    for _ in range(300):
        n = int(rng.integers(4, 200))
        a = np.unique(rng.integers(1, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.concatenate([rng.permutation(a)[: int(len(a) * rng.uniform(0.7, 1))], rng.integers(1, 1 << 62, max(1, n // 10), dtype=np.uint64)]))
        if jaccard.links(a, b):
            met += 1
            assert all(jaccard.share(jaccard.short_prefix(a, k), jaccard.short_prefix(b, k)) for k in range(2))
            assert jaccard.may_link(jaccard.parity(a), len(a), jaccard.parity(b), len(b))
    assert met > 100


# ---- op9 ------------------------------------------------------------------------------------------


def test_packing_against_plain_best_fit(spark, empty):
    from kinweave.llm import packing

    rng = random.Random(8)
    for most in (4096, 700, 40):
        sizes = sorted((rng.randint(1, most) for _ in range(600)), reverse=True)
        assert packing.pack(sizes) == best_fit(sizes)
    rows = [(i, words(rng, rng.randint(0, 3000))) for i in range(40)] + [(None, words(rng, 10)), (None, None), (3, "a b"), (3, "a b"), (4, words(rng, 30_000))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit("own"), "g": F.lit("own"), "bin": F.lit("own")})
    got = packing.pack_documents(docs, group=10_000).collect()
    spans = Counter()
    for r in got:
        spans[r["doc_id"]] += r["length"]
    want = Counter()
    for d, t in rows:
        want[d] += len((t or "").split())
    assert spans == +want
    sizes = sorted((r["length"] for r in got), reverse=True)
    assert Counter(r["bin_length"] for r in {r["bin"]: r for r in got}.values()) == Counter({i: f for i, f in zip(best_fit(sizes)[0], best_fit(sizes)[2], strict=True)}.values())
    tokens = packing.pack_documents(spark.createDataFrame([(1, 5000), (2, 10)], "doc_id long, n_tokens long"), size=F.col("n_tokens"))
    assert sorted((r["doc_id"], r["start"], r["length"]) for r in tokens.collect()) == [(1, 0, 4096), (1, 4096, 904), (2, 0, 10)]


# ---- op10 -----------------------------------------------------------------------------------------


def test_substring_cases(spark, empty):
    from kinweave.llm import recompress

    rng = random.Random(6)
    passage, other = words(rng, 50, 5000), words(rng, 36, 5000)
    rows = [(i, f"{words(rng, rng.randint(0, 80), 5000)} {passage} {words(rng, 5, 5000)}") for i in range(40)]
    rows += [(None, f"a {other}"), (None, f"b {other} c"), (None, None), (5, ""), (5, passage), (5, passage), (6, f"{passage} {passage}"), (77, words(rng, 40_000, 50_000) + " " + passage)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("_id", "_ats", "row_hash", "places", "id", "ats")}).repartition(3)
    want = [(str(d), *x) for (d, _), x in zip(rows, without_repeats([t for _, t in rows]), strict=True)]
    got = recompress.remove_repeats(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], str(r["text"])) for r in got) == sorted((*x[:3], str(x[3])) for x in want)
    assert all(r[c] == "own" for r in got for c in ("_id", "_ats", "row_hash", "places", "id", "ats"))
    assert recompress.remove_repeats(empty, digest=True).collect() == []


# ---- shared ---------------------------------------------------------------------------------------


def test_components_of_a_star_and_chains(spark):
    from kinweave.llm.common import components

    edges = [(1, i) for i in range(2, 400)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 1 for i in range(1, 400)) and all(got[1000 + i] == 1000 for i in range(61)) and got[5000] == 5000


def test_bloom_filters(spark):
    import numpy as np

    from kinweave.llm.common import bloom_bits, bloom_has, bloom_of

    made = bloom_of(spark.range(0, 50_000, 1, 3), "id", bloom_bits(50_000))
    assert bloom_has(made, np.arange(50_000, dtype=np.uint64)).all()
    assert bloom_has(made, np.arange(10**6, 10**6 + 50_000, dtype=np.uint64)).mean() < 0.01
    assert bloom_bits(10**12) == 1 << 29
