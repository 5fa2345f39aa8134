"""Goldens by hand, and brute-force twins of the capped joins."""

import random

import pytest
from pyspark.sql import functions as F

from kinweave.functions import normalize as N
from kinweave.functions import similarity as S
from kinweave.functions.keys import blocking_keys, soundex
from kinweave.operators import blocking, metrics, rank, validate
from kinweave.sources.io import parse_candidates, with_match_count

NAMES = [
    ("B+ Retail Inc.", "b retail incorporated", "b retail incorporated"),
    ("Café Müller & Co.", "cafe muller company", "cafe muller company"),
    ("pvt_ltd Co-op", "pvt ltd company op", "pvt ltd company op"),
    ("Straße GmbH", "strae gmbh", "straße gmbh"),
    ("Łódź Corp", "odz corporation", "łodz corporation"),
    ("½ Price LLC", "12 price limited liability company", "1⁄2 price limited liability company"),
    ("ﬁne Ａrt", "fine art", "fine art"),
    ("हिंदी कंपनी.", "", None),
    ("हिंदी 42", "42", None),
    ("компания ООО", "компания ооо", "компания ооо"),
    ("***", "", ""),
    ("  ", "", ""),
    (None, "", ""),
]
ADDRESSES = [
    ("1795 Westchester Dr., High Point, NC", "1795 westchester drive high point nc"),
    ("12B St. Louis Rd, Apt 4, 560001", "12b street louis road apartment 4 560001"),
    ("Nr. Sq, 5th Ave", "near square 5th avenue"),
]


def test_names(spark):
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(NAMES)], "i int, t string")
    got = dict(df.select("i", N.clean_vectorized(F.col("t"), N.NAME_WORDS).alias("v")).collect())
    assert [got[i] for i in range(len(NAMES))] == [x[1] for x in NAMES]
    for raw, _, scalar in NAMES:
        if scalar is not None:
            assert N.clean_scalar_text(raw, N.NAME_WORDS) == scalar


def test_fold_every_character(spark):
    import unicodedata

    chars = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(i, f"a{c}b") for i, c in enumerate(chars)], "i int, t string")
    got = dict(df.select("i", N.fold_ascii(F.col("t"))).collect())
    want = {i: "a" + "".join(x for x in unicodedata.normalize("NFKD", c) if ord(x) < 128) + "b" for i, c in enumerate(chars)}
    assert {i: (got[i], want[i]) for i in want if got[i] != want[i]} == {}


@pytest.mark.parametrize("raw,want", ADDRESSES)
def test_addresses(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(N.clean_vectorized(F.col("t"), N.ADDRESS_WORDS)).first()[0] == want
    assert N.clean_scalar_text(raw, N.ADDRESS_WORDS) == want


KEYS = [
    (("acme technologies private limited", "india", ""), ["c5:india_acme ", "c7:india_acme te", "ct:india_technologies", "p7:acme te", "st:acme_limited_private_technologies", "ph:india_T254"]),
    (("the abc", "", ""), ["ph:xx_T000"]),
    (("", "india", "12 mg road"), ["ca:india_12 mg", "ap:12 mg r", "aa:india_12 mg "]),
    (("abc", "", ""), []),
]


@pytest.mark.parametrize("record,want", KEYS)
def test_keys(spark, record, want):
    df = spark.createDataFrame([("S1-1", 0, 0, record[0], record[2], record[1])], "entity_id string, src_ord int, row_ord long, name_clean string, address_clean string, country_clean string")
    assert [r["key"] for r in blocking_keys(df).orderBy("ord").collect()] == want


def test_soundex(spark):
    want = {"robert": "R163", "ashcraft": "A261", "tymczak": "T522", "pfister": "P236", "3mcompany": "3525"}
    df = spark.createDataFrame([(t,) for t in want], "t string")
    assert dict(df.select("t", soundex(F.col("t"))).collect()) == want


def test_similarity():
    a, b = "acme technologies private limited", "acme tech private limited"
    assert S.lcs(a, b) == 25 and round(S.ratio(a, b), 6) == 86.206897
    x, y = "12b street louis road apartment 4 560001", "12 street louis road 560001"
    assert S.lcs(x, y) == 27 and round(0.7 * S.ratio(a, b) + 0.3 * S.ratio(x, y), 6) == 84.523932
    assert (S.ratio("", ""), S.partial_ratio("", ""), S.token_sort("", ""), S.token_set("", ""), S.wratio("", "")) == (100, 100, 100, 0, 0)
    rng = random.Random(1)
    for _ in range(300):
        p, q = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 30))) for _ in range(2))
        table = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
        for i, c in enumerate(p):
            for j, d in enumerate(q):
                table[i + 1][j + 1] = table[i][j] + 1 if c == d else max(table[i][j + 1], table[i + 1][j])
        assert S.lcs(p, q) == table[-1][-1]
        if p and q:
            short, long = sorted((p, q), key=len)
            both = [(short, long)] + [(long, short)] * (len(p) == len(q))
            best = max(S.ratio(s, t[max(0, i) : i + len(s)]) for s, t in both for i in range(1 - len(s), len(t)))
            assert S.partial_ratio(p, q) == best


def loop_candidates(s1_keys, other_keys, per_key, per_entity, before):
    index = {}
    for id_, _, _, _, key in sorted(other_keys, key=lambda r: (r[1], r[2])):
        bucket = index.setdefault(key, [])
        if id_ not in bucket and len(bucket) < per_key:
            bucket.append(id_)
    out = set()
    for s in {r[0] for r in s1_keys}:
        found = set()
        for r in sorted((r for r in s1_keys if r[0] == s), key=lambda r: r[3]):
            found |= set(index.get(r[4], ()))
            if len(found) >= before:
                break
        out |= {(s, c) for c in sorted(found - {s})[:per_entity]}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_candidates_against_loop(spark, seed):
    rng = random.Random(seed)
    schema = "entity_id string, src_ord int, row_ord long, ord int, key string"
    rows = lambda k, n: [(f"S{k + 1}-{i}", k, i, o, f"{o}:{rng.randint(0, 3)}") for i in range(n) for o in range(1, 5)]
    s1, others = rows(0, 25), rows(1, 60) + rows(2, 60) + [("S1-3", 1, 999, 1, "1:1")]
    a, b = spark.createDataFrame(s1, schema), spark.createDataFrame(others, schema)
    got = blocking.candidate_pairs(a, blocking.inverted_index(b, a, 12), 8, 20)
    assert {tuple(r) for r in got.collect()} == loop_candidates(s1, others, 12, 8, 20)


def test_rank_ties_take_the_larger_id(spark):
    df = spark.createDataFrame([("a", "x", 60.0), ("a", "y", 60.0), ("a", "z", 40.0)], "s1_id string, cand_id string, score double")
    assert [(r["cand_id"], r["matched"]) for r in rank.rank_candidates(df, 2).orderBy("rn").collect()] == [("y", True), ("x", True)]


def test_macro_f05(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "s1_id string, cand_id string")
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "s1_id string")
    got = metrics.macro_f05(ids, pairs([("a", "1"), ("a", "2"), ("b", "1")]), pairs([("a", "1"), ("b", "1"), ("b", "2")])).first()
    assert round(got["macro_f05"], 6) == 0.462963


def test_cells(spark):
    df = spark.createDataFrame([("a", "S2-1,S2-2"), ("b", ""), ("c", "  "), ("d", "S2-1,")], "source1_entity_id string, matched_entity_ids string")
    assert {r[0]: r["match_count"] for r in with_match_count(df).collect()} == {"a": 2, "b": 0, "c": 0, "d": 2}
    rows = spark.createDataFrame([("a", "x", 0), ("a", " S2-10 ,S2-1,,S2-10", 1)], "source1_entity_id string, candidate_entity_ids string, row_ord long")
    assert [(r["pos"], r["cand_id"]) for r in parse_candidates(rows).orderBy("pos").collect()] == [(0, "S2-10"), (1, "S2-1")]


def test_validate(spark):
    df = lambda rows, *c: spark.createDataFrame(rows, ", ".join(f"{x} string" for x in c))
    s1, ok = df([("S1-1",), ("S1-2",)], "entity_id"), df([("S2-1",), ("S3-1",)], "entity_id")
    good = validate.validate_submission(df([("S1-1", "S2-1"), ("S1-2", "")], "s1_id", "matched"), df([("S1-1", "S2-1,S3-1"), ("S1-2", "")], "s1_id", "candidates"), s1, ok)
    assert good.isEmpty()
    bad = validate.validate_submission(df([("S1-1", "S3-1,S3-1"), ("S1-3", "nan")], "s1_id", "matched"), df([("S1-1", "S2-1"), ("S1-2", "S9-9")], "s1_id", "candidates"), s1, ok)
    assert {r["rule"].split()[0] for r in bad.collect()} == {"V5", "V7", "V9", "V10", "V11", "V12"}


def test_stream_equals_batch(spark, tmp_path):
    from kinweave.functions.normalize import normalize_entities
    from kinweave.streaming.match import stream_candidates

    rows = [("S1-1", "Acme Technologies Ltd", "1 Main St", "india", 0, 0), ("S2-1", "ACME Technologies Limited", "", "india", 1, 0), ("S3-1", "Other Firm", "", "de", 2, 0)]
    raw = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, src_ord int, row_ord long")
    index = blocking.inverted_index(blocking_keys(normalize_entities(raw.where("src_ord > 0"))))
    raw.where("src_ord = 0").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    q = stream_candidates(stream, index).writeStream.format("memory").queryName("met").start()
    q.processAllAvailable()
    q.stop()
    assert {(r["s1_id"], r["cand_id"]) for r in spark.table("met").collect()} == {("S1-1", "S2-1")}


def test_tsv_round_trip(spark, tmp_path):
    from kinweave.sources.io import read_source, write_tsv

    df = spark.createDataFrame([("S1-1", 'a "b"', "", "NA")], "entity_id string, business_name string, business_address string, country string")
    write_tsv(df, str(tmp_path / "t"))
    assert [tuple(r)[:4] for r in read_source(spark, str(tmp_path / "t"), 0).collect()] == [("S1-1", 'a "b"', "", "NA")]


def test_model(spark):
    from kinweave.functions.features import FEATURES
    from kinweave.plans import model

    rng = random.Random(3)
    rows = []
    for i in range(120):
        label = i % 2
        rows.append((f"S1-{i // 4}", f"S2-{i}", label, *[label * 0.8 + rng.random() * 0.2 for _ in FEATURES]))
    df = spark.createDataFrame(rows, ", ".join(["s1_id string", "cand_id string", "label int", *(f"{f} float" for f in FEATURES)])).coalesce(2).persist()
    made = model.train(df, "logistic")
    score = {r["cand_id"]: r["score"] for r in model.predict(made, df).collect()}
    assert all((score[r[1]] > 0.5) == (r[2] == 1) for r in rows)
