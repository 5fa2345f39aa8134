"""The cascade in one piece and in shards, and columns of its own names."""

import hashlib
import random

from pyspark.sql import functions as F


def test_shards_and_literals(spark):
    from kinweave.llm import urlfilter as U

    rng = random.Random(3)
    keys = [(f"h{i}.net/{rng.random()}", rng.random() < 0.3) for i in range(3000)]
    df = spark.createDataFrame(keys, "key string, listed boolean").repartition(3)
    for made in (U.build_cascade(df), U.build_cascade(df, 64, 100), U.build_cascade(df, 64, 7)):
        got = {r["key"]: r["x"] for r in made.judge(df.select("key"), F.col("key"), "x").collect()}
        assert got == dict(keys)
    none = U.build_cascade(df.where("not listed")).judge(df.select("key"), F.col("key"), "x")
    assert none.where("x").isEmpty()
    alls = U.build_cascade(df.where("listed"), 64, 50).judge(df.where("listed").select("key"), F.col("key"), "x")
    assert alls.where("not x").isEmpty()


def test_clashing_columns_repeats_and_empty(spark):
    from kinweave.llm import urlfilter as U

    rows = [(i % 40, f"http://h{i % 60}.net/{i % 60}") for i in range(200)] + [(None, None), (None, "http://x.org/" + "a" * 100_000)]
    clash = ("is_listed", "IS_LISTED_", "in_list", "shard_of_key", "levels_of_shard", "_key", "key", "listed")
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("own") for c in clash if c != "IS_LISTED_"}).withColumn("host", F.lit(1))
    for most, keys in ((U.MOST_BITS, U.SHARD_KEYS), (8, 5)):
        out = U.filter_urls(pages, U.stand_in_list(F.col("key")), most_bits=most, shard_keys=keys)
        got = out.collect()
        assert len(got) == len(rows) and all(r[c] == "own" for r in got for c in clash if c != "IS_LISTED_")
        for r in got:
            if r["rule"] is None:
                assert r["verdict"] == ("block" if hashlib.md5((r["host"] + r["path"]).encode()).hexdigest()[0] in "01" else "allow")
        assert U.filter_urls(pages.limit(0), U.stand_in_list(F.col("key")), most_bits=most, shard_keys=keys).collect() == []
