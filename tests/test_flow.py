"""The stages over files, and what they are made of, on several partitions."""

import json
import random

import pytest
from pyspark.sql import functions as F

from kinweave.functions import similarity as S
from kinweave.operators import lookup, metrics, rank, validate
from kinweave.plans import flow as flows
from kinweave.sources import io

WORDS = "acme orion delta harbor summit river stone maple cedar falcon granite ember willow aurora beacon copper".split()


def _write(path, rows, columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join("\t".join(r) for r in [columns, *rows]) + "\n")


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    rng = random.Random(8)
    columns = ["entity_id", "business_name", "business_address", "country"]
    for split in ("train", "test"):
        sources, truth = {1: [], 2: [], 3: []}, []
        for i in range(80):
            name = " ".join(rng.sample(WORDS, 3))
            address = f"{rng.randint(1, 99)} {rng.choice(WORDS)} St. {rng.randint(10000, 99999)}"
            country = rng.choice(["India", "Brazil"])
            sources[1].append([f"S1-{i:03d}", f"{name} Ltd.", address, country])
            mine = []
            for k in (2, 3):
                if rng.random() < 0.7:
                    sources[k].append([f"S{k}-{i:03d}", f"{name.upper()} limited", address.replace("St.", "Street"), country])
                    mine.append(f"S{k}-{i:03d}")
                sources[k].append([f"S{k}-9{i:03d}", f"{name.split()[0]} {' '.join(rng.sample(WORDS, 2))} inc", f"{rng.randint(1, 99)} other road", country])
            truth.append([f"S1-{i:03d}", ",".join(mine)])
        sources[2].append(["S2-9000", "late name wins", "", "India"])
        for k, rows in sources.items():
            _write(root / split / f"source{k}.tsv", rows, columns)
        if split == "train":
            _write(root / split / "ground_truth.tsv", truth, ["source1_entity_id", "matched_entity_ids"])
    return str(root)


@pytest.fixture(scope="module")
def flow(spark, files, tmp_path_factory):
    out = flows.Flow(spark, io.Catalogue(files), str(tmp_path_factory.mktemp("out")))
    out.files = files
    return out


def test_row_order_has_no_gaps(spark):
    df = spark.range(0, 1000, 1, 7)
    got = [tuple(r) for r in io.with_row_ord(df).orderBy("id").collect()]
    assert got == [(i, i) for i in range(1000)]
    assert io.with_row_ord(spark.range(0)).collect() == []


def test_first_entities_over_partitions(spark):
    df = io.with_row_ord(spark.range(0, 100, 1, 5)).withColumn("src_ord", F.lit(0))
    assert sorted(r["id"] for r in flows.first_entities(df, 60).collect()) == list(range(60))


def test_last_rows_win(spark):
    rows = [("S2-1", "a", 1, 0), ("S2-1", "b", 1, 5), ("S3-1", "c", 2, 0), ("S2-1", "d", 2, 1), ("S1-1", "e", 0, 0), ("S1-1", "f", 0, 1)]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, src_ord int, row_ord long").repartition(3)
    assert {(r[0], r[1]) for r in lookup.last_wins(df).collect()} == {("S2-1", "d"), ("S3-1", "c"), ("S1-1", "f")}
    assert {(r[0], r[1]) for r in lookup.load_lookup(df.where("src_ord = 1"), df.where("src_ord = 2")).collect()} == {("S2-1", "d"), ("S3-1", "c")}


def test_stages(flow, spark):
    flow.load_data()
    flow.blocking("train", 25)
    assert flow.pairs("train").select("s1_id").distinct().count() <= 25
    flow.blocking("train")
    flow.blocking("test")
    meta = flow.train()
    assert meta["n_train_pairs"] > 0 and 0 < meta["pos_rate_train"] < 1 and meta["best_iteration"] > 0
    for name in ("model_config", "validation_summary", "selected_threshold", "feature_columns"):
        assert io.read_json(spark, flow.path(f"{name}.json"))
    assert len(io.read_json(spark, flow.path("feature_columns.json"))) == 47
    assert io.exists(spark, flow.path("model")) and io.exists(spark, flow.path("baseline_model"))
    found = flow.evaluate()
    assert found["n_entities"] == 80 and found["blocking_recall_ceiling"] > 0.9 and found["macro_f05"] > 0.5
    flow.predict()
    assert flow.validate() == []
    assert flow.submit() == 80
    ids = [r["source1_entity_id"] for r in io.read_tsv(spark, flow.path("matches_complete.tsv"), io.TRUTH).collect()]
    assert ids == sorted(ids)
    assert flow.demo().count() == 5
    flow.rank("both", 3, 50.0)
    assert flow.read_lists("ranked_matches-test.tsv", "matched").count() == 80


def test_all_runs_the_evaluation(files, spark, tmp_path, monkeypatch):
    ran = []
    for name in ("load_data", "blocking", "train", "evaluate"):
        monkeypatch.setattr(flows.Flow, name, lambda self, *a, n=name: ran.append(n))
    flows.main(["--root", files, "--out", str(tmp_path), "--stage", "all"])
    assert ran == ["load_data", "blocking", "train", "evaluate"]


def test_files_and_columns(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("source1_entity_id\twrong\nS1-1\t\n")
    got = validate.validate_files(spark, {"matches": str(tmp_path / "m.tsv"), "candidates": str(tmp_path / "none.tsv")})
    assert [x[0].split()[0] for x in got] == ["V2", "V1"]
    with pytest.raises(Exception, match="header"):
        io.read_tsv(spark, str(tmp_path / "m.tsv"), io.TRUTH).collect()


def test_sweep_against_thresholds(spark):
    rng = random.Random(6)
    ids = [f"S1-{i}" for i in range(30)]
    scored = [(s, f"S2-{j}", rng.random()) for s in ids for j in range(rng.randint(0, 6))]
    true = [(s, c) for s, c, x in scored if rng.random() < x] + [(s, "S3-1") for s in ids[::4]]
    a, b, c = spark.createDataFrame([(x,) for x in ids], "s1_id string"), spark.createDataFrame(scored, "s1_id string, cand_id string, score double"), spark.createDataFrame(true, "s1_id string, cand_id string")
    got = {round(r["threshold"], 2): tuple(round(r[k], 9) for k in ("macro_f05", "macro_precision", "macro_recall")) for r in metrics.threshold_sweep(a, b, c).collect()}
    assert len(got) == 50
    for step in (50, 61, 75, 99):
        one = metrics.macro_f05(a, b.where(F.floor(F.col("score") * 100 + 1e-9) >= step), c).first()
        assert got[step / 100] == tuple(round(one[k], 9) for k in ("macro_f05", "macro_precision", "macro_recall"))


def test_recall_ceiling(spark):
    pairs = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "s1_id string, cand_id string")
    true = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", "x")], "s1_id string, cand_id string")
    assert tuple(metrics.recall_ceiling(pairs, true).first()) == (1, 3, 1 / 3)
    assert metrics.recall_ceiling(pairs, true.limit(0)).first()["recall_ceiling"] == 0


def test_sample_rows(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("entity_id"))
    assert [r[0] for r in rank.sample_rows(df).collect()] == [r[0] for r in rank.sample_rows(df.repartition(7)).collect()]


def test_combed_equals_windows():
    rng = random.Random(2)
    text = lambda low, high: "".join(rng.choice("abc ") for _ in range(rng.randint(low, high)))
    pairs = []
    for _ in range(200):
        a = text(1, 60)
        pairs.append((a, a[:3] + text(len(a), 120)))
    got = S.combed(pairs)
    for k, (a, b) in enumerate(pairs):
        assert S.combed([(a, b)])[:, 0].tolist() == [S.lcs(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b))]
        assert got[: len(a) + len(b) - 1, k].tolist() == S.combed([(a, b)])[:, 0].tolist()


def test_partial_ratios_together():
    rng = random.Random(3)
    text = lambda: "".join(rng.choice("ab c") for _ in range(rng.randint(0, 40)))
    pairs = [(text(), text()) for _ in range(300)] + [("", ""), ("a", ""), ("ab", "ba")]

    def brute(a, b):
        if not a or not b:
            return 100.0 if a == b else 0.0
        short, long = sorted((a, b), key=len)
        both = [(short, long)] + [(long, short)] * (len(a) == len(b))
        return max(S.ratio(s, t[max(0, i) : i + len(s)]) for s, t in both for i in range(1 - len(s), len(t)))

    assert S.partial_ratios(pairs) == [brute(*x) for x in pairs]


def test_features_against_plain_functions(spark):
    """The edit similarities and what is made of them, pair by pair."""
    from kinweave.functions.features import FEATURES, pair_features

    rng = random.Random(5)
    text = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 5)))
    rows = [(f"S1-{i}", f"S{2 + i % 2}-{i}", 3, text(), text(), rng.choice(["", "in", "br"]), text(), text(), rng.choice(["", "in", "br"])) for i in range(60)]
    columns = "s1_id string, cand_id string, n_cands long, s1_name string, s1_addr string, s1_country string, cand_name string, cand_addr string, cand_country string"
    for r in pair_features(spark.createDataFrame(rows, columns)).collect():
        x = rows[int(r["s1_id"][3:])]
        n, a = (x[3], x[6]), (x[4], x[7])
        want = {"name_jw": S.wratio(*n), "name_ratio": S.ratio(*n), "name_partial": S.partial_ratio(*n), "name_token_sort": S.token_sort(*n), "name_token_set": S.token_set(*n), "addr_jw": S.wratio(*a), "addr_ratio": S.ratio(*a), "addr_token_sort": S.token_sort(*a), "addr_token_set": S.token_set(*a)}
        want = {k: v / 100 for k, v in want.items()}
        p, q = want["name_jw"], want["addr_jw"]
        same = x[5] != "" and x[5] == x[8]
        want |= {"name_x_addr": p * q, "name_plus_addr": p + q, "min_name_addr": min(p, q), "max_name_addr": max(p, q), "same_country_high_name": float(same and p >= 0.85), "high_name_and_high_addr": float(p >= 0.85 and q >= 0.85)}
        assert all(abs(r[k] - v) < 1e-5 for k, v in want.items()), (x, want)
        assert len(r) == 2 + len(FEATURES)


def test_json_round_trip(spark, tmp_path):
    io.write_json({"a": [1, 2]}, str(tmp_path / "x.json"), spark)
    assert io.read_json(spark, str(tmp_path / "x.json")) == {"a": [1, 2]} == json.loads('{"a": [1, 2]}')
