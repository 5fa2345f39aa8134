"""Bounds of features hold, and a model's scores are the same where only bounds were looked at."""

import random

import numpy as np

from kinweave.functions.bounds import bounded_features, trees_of
from kinweave.functions.features import FEATURES, counted
from kinweave.functions.normalize import normalize_entities
from kinweave.plans import flow, model


def _entities(spark):
    rng = random.Random(7)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ran", "tel", "s", "") for c in ("", "o", "9", "é")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for i in range(40):
        name, addr = text(rng.randint(1, 6)), text(rng.choice((0, 3, 40, 90)))
        near = addr[:-1] + "x" if i % 3 else addr
        rows += [(f"S1-{i}", name, addr, "a", 0, i), (f"S2-{i}", name if i % 4 else name + " o", near, "a" if i % 5 else "", 1, i)]
        rows += [(f"S3-{i}", text(rng.randint(0, 4)), text(rng.randint(0, 60)) if i % 2 else addr * 5, "b", 2, i)]
    rows += [("S1-x", "", "", "a", 0, 40), ("S2-x", "", "", "", 1, 40), ("S3-x", "k", "€" * 70000, "", 2, 40), ("S1-y", "k", "€" * 70001, "", 0, 41)]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, src_ord int, row_ord long")
    return flow.held(normalize_entities(df, "scalar"))


def test_scores_from_bounds_are_the_features_scores(spark):
    entities = _entities(spark)
    s1, others = entities.where("src_ord = 0"), entities.where("src_ord > 0")
    all_pairs = s1.selectExpr("entity_id as s1_id", "row_ord as i").join(others.selectExpr("entity_id as cand_id", "row_ord as k"))
    pairs = flow.held(all_pairs.where("abs(i - k) < 3").select("s1_id", "cand_id"))
    full = flow.all_features(entities, pairs).toPandas().set_index(["s1_id", "cand_id"])
    at = lambda df: full.loc[list(zip(df["s1_id"], df["cand_id"], strict=True))]
    low = bounded_features(counted(pairs), s1, others, [(f, -1.0, 0.0, 1.0) for f in range(len(FEATURES))]).toPandas()
    assert len(low) == len(full) and (np.array(low["seen"].tolist()) <= at(low)[list(FEATURES)].to_numpy(np.float32)).all()
    for name in ("name_jw", "addr_lev", "addr_jaccard", "name_containment", "addr_token_sort", "name_x_addr"):  # whatever is sure to be below isn't above
        f, cut = FEATURES.index(name), float(full[name].median()) + 0.01
        met = bounded_features(counted(pairs), s1, others, [(f, cut, 0.0, 1.0)]).where("sure").toPandas()
        assert len(met) and ((np.array(met["seen"].tolist())[:, 0] > cut) == (at(met)[name].to_numpy(float) > cut)).all(), name
    rows = full.reset_index().assign(label=lambda x: ((x["name_x_addr"] > 0.9) | (x["addr_lev"] > 0.97)).astype(int))
    made = model.train(spark.createDataFrame(rows), rounds=2)
    trees = trees_of(made)
    open_ = bounded_features(counted(pairs), s1, others, trees).where("not sure").count()
    assert open_ < len(rows)
    key = ["s1_id", "cand_id"]
    lazily, plainly = (model.predict(made, x).toPandas().sort_values(key).reset_index(drop=True) for x in (flow.all_features(entities, pairs, made), spark.createDataFrame(rows)))
    assert lazily[key].equals(plainly[key]) and np.allclose(lazily["score"], plainly["score"], rtol=0, atol=1e-10) and len(lazily) == pairs.count()
    # A model without trees looks at everything.
    assert trees_of(model.train(spark.createDataFrame(rows), "logistic")) == []
