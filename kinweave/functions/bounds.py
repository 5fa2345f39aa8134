"""Features of pairs as far as a model of trees looks at them, from bounds made of short signatures of the records.

A tree that goes the same way for all values between a feature's bounds needs no edit distance to go it. Most pairs are
far from equal, which lengths and counts of characters and words show already; only the texts of the others are compared.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.functions.features import FEATURES, HIGH, PATTERNS, _equal, country_features, first_match
from kinweave.functions.keys import tokens

#: Slots for the counts of a text's characters and of its distinct words, which several of them share: that only raises what two texts may have in common.
CHARACTERS, WORDS, MOST = 32, 64, (1 << 16) - 1
#: Leaves that differ by no more, as equal ones do by the order of their sums, are one leaf.
EQUAL = 1e-12
PLACE = {f: i for i, f in enumerate(FEATURES)}


@F.pandas_udf(T.StructType([T.StructField("counts", T.BinaryType()), T.StructField("words", T.IntegerType())]))
def counts_udf(texts: pd.Series) -> pd.DataFrame:
    counts, sizes = [], []
    for text in texts:
        words = set(text.split(" ")) - {""}
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) % CHARACTERS
        slots = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORDS for w in words), np.int64, len(words))
        both = np.concatenate([np.bincount(code, minlength=CHARACTERS), np.bincount(slots, minlength=WORDS)])
        counts.append(np.minimum(both, MOST).astype("<u2").tobytes())
        sizes.append(len(words))
    return pd.DataFrame({"counts": pd.Series(counts, dtype=object), "words": pd.Series(sizes, dtype="int32")})


def signatures(entities: DataFrame, k: str) -> DataFrame:
    """k_id and a few hundred bytes that stand for a normalised record, in columns that begin with k."""
    named = lambda c: F.unhex(F.md5(c))
    name, addr = F.col("name_clean"), F.col("address_clean")
    end = lambda i: F.try_element_at(tokens(name), F.lit(i))
    bound = entities.withColumns({"_n": counts_udf(name), "_a": counts_udf(addr)})
    return bound.select(
        F.col("entity_id").alias(f"{k}_id"), F.col("country_clean").alias(f"{k}_country"), F.substring(name, 1, 4).alias(f"{k}_prefix4"),
        named(end(1)).alias(f"{k}_first"), named(end(-1)).alias(f"{k}_last"), *(first_match(addr, p).alias(f"{k}_{f}") for f, p in PATTERNS.items()),
        *(x.alias(f"{k}_{side}_{what}") for side, c, u in (("name", name, "_n"), ("addr", addr, "_a"))
          for what, x in (("is", named(c)), ("len", F.length(c)), ("counts", F.col(f"{u}.counts")), ("words", F.col(f"{u}.words")))),
    )


def _side(pdf: pd.DataFrame, side: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Bounds of a side's similarities and sets, for records whose white space is single blanks."""
    la, lb = (pdf[f"{k}_{side}_len"].to_numpy(float) for k in ("s1", "cand"))
    wa, wb = (pdf[f"{k}_{side}_words"].to_numpy(float) for k in ("s1", "cand"))
    x, y = (np.frombuffer(b"".join(pdf[f"{k}_{side}_counts"]), "<u2").reshape(-1, CHARACTERS + WORDS) for k in ("s1", "cand"))
    same = (pdf[f"s1_{side}_is"] == pdf[f"cand_{side}_is"]).to_numpy()
    both = np.minimum(x, y)
    cut = (x.max(1) == MOST) | (y.max(1) == MOST)
    least, most = np.minimum(la, lb), np.maximum(la, lb)
    letters = np.where(cut, least, np.minimum(least, both[:, :CHARACTERS].sum(1, dtype=float)))
    shared = np.where(cut, np.minimum(wa, wb), np.minimum(np.minimum(wa, wb), both[:, CHARACTERS:].sum(1, dtype=float)))
    shared = np.where(same, wa, shared)
    share = lambda common: np.minimum(1.0, 2 * common / np.maximum(la + lb, 1) + 1e-9)
    # Different texts of one length have less in common than all.
    ratio, in_order = share(np.where(la == lb, np.minimum(letters, la - 1), letters)), share(letters)
    longer = most / np.maximum(least, 1)
    weighted = np.where(longer < 1.5, np.maximum(ratio, 0.95), np.maximum(ratio, np.where(longer <= 8, 0.9, 0.6)))
    # Equal texts are alike by any measure; empty ones by some.
    full, empty, alike = same & (wa > 0), least == 0, np.where(most == 0, 1.0, 0.0)
    edit = lambda top, bare=0.0: (np.where(empty, bare, np.where(full, 1.0, 0.0)), np.where(empty, bare, np.where(full, 1.0, top)))
    distance = np.where(same, 0, most), np.where(same, 0, np.maximum(most - letters, 1))  # falling: the farthest is the least alike
    either = np.maximum(wa + wb - shared, 1)
    none, plain = wa + wb == 0, np.zeros(len(la))
    of_first = np.where(wa == 0, np.where(wb == 0, 1.0, 0.0), shared / np.maximum(wa, 1))
    jaccard = np.where(none, 1.0, shared / either)
    return {
        "jw": edit(weighted), "ratio": edit(ratio, alike), "partial": edit(1.0, alike), "token_sort": edit(in_order, alike), "token_set": edit(1.0),
        "lev": tuple(np.where(most == 0, 1.0, 1 - d / np.maximum(most, 1)) for d in distance),
        "jaccard": (np.where(same | none, jaccard, plain), jaccard), "containment": (np.where(same | (wa == 0), of_first, plain), of_first),
        "shared_tokens": (np.where(same, shared, plain), shared), "digit_jaccard": (np.where(same, 1.0, plain), plain + 1),
        "len_diff": (most - least,) * 2, "len_ratio": (least / np.maximum(most, 1),) * 2,
    }


def bounds(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest values of FEATURES, (pairs, features) each."""
    low, high = np.zeros((2, len(pdf), len(FEATURES)), np.float32)

    def put(f, lo, hi):
        if f in PLACE:
            low[:, PLACE[f]], high[:, PLACE[f]] = lo, hi

    sides = {side: _side(pdf, side) for side in ("name", "addr")}
    for side, made in sides.items():
        for f, x in made.items():
            put(f"{side}_{f}", *x)
    known = {f: pdf[f].to_numpy(float) for f in FEATURES if f in pdf}
    for f, x in known.items():
        put(f, x, x)
    n, a = sides["name"]["jw"], sides["addr"]["jw"]
    same = known["country_exact"] == 1
    for f, made in (
        ("name_x_addr", lambda x, y: x * y), ("name_plus_addr", lambda x, y: x + y), ("min_name_addr", np.minimum), ("max_name_addr", np.maximum),
        ("same_country_high_name", lambda x, y: same & (x >= HIGH)), ("same_country_high_addr", lambda x, y: same & (y >= HIGH)),
        ("exact_name_exact_country", lambda x, y: same & (known["name_exact"] == 1)), ("exact_addr_exact_country", lambda x, y: same & (known["addr_exact"] == 1)),
        ("high_name_and_high_addr", lambda x, y: (x >= HIGH) & (y >= HIGH)),
    ):
        put(f, made(n[0], a[0]), made(n[1], a[1]))
    return low, high


def trees_of(model) -> list:
    """The trees of a fitted pipeline: (feature, threshold, left, right), a leaf its value; none if it has no trees."""

    def node(x):
        if x.subtreeDepth() == 0:
            return float(x.prediction())
        split = x.split()
        return int(split.featureIndex()), float(split.threshold()), node(x.leftChild()), node(x.rightChild())

    return [node(t._java_obj.rootNode()) for t in getattr(model.stages[-1], "trees", [])]


def _looked_at(tree) -> set[int]:
    return {tree[0]} | _looked_at(tree[2]) | _looked_at(tree[3]) if isinstance(tree, tuple) else set()


def reached(tree, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest leaf of a tree that values between the bounds lead to."""
    if not isinstance(tree, tuple):
        return (np.full(len(low), tree),) * 2
    f, threshold, *below = tree
    least, most = np.full(len(low), np.inf), np.full(len(low), -np.inf)
    for may, part in zip((low[:, f] <= threshold, high[:, f] > threshold), below, strict=True):
        at = np.flatnonzero(may)
        if len(at):
            x, y = reached(part, low[at], high[at])
            least[at], most[at] = np.minimum(least[at], x), np.maximum(most[at], y)
    return least, most


def bounded_features(pairs: DataFrame, s1: DataFrame, lookup: DataFrame, trees: list) -> DataFrame:
    """(s1_id, cand_id, n_cands, seen, sure) of pairs (s1_id, cand_id, n_cands): values of the features that the trees look at, in order, and
    whether they lead to the leaves that the features themselves lead to, or to ones within EQUAL of them."""
    c = F.col
    met = pairs.join(signatures(lookup, "cand"), "cand_id").join(signatures(s1, "s1"), "s1_id")
    equal = lambda f: _equal(c(f"s1_{f}"), c(f"cand_{f}"))
    whole = lambda side: F.when((c(f"s1_{side}_len") > 0) & (c(f"s1_{side}_is") == c(f"cand_{side}_is")), 1.0).otherwise(0.0)
    ends = {f"name_{e}_token_match": F.coalesce((c(f"s1_{e}") == c(f"cand_{e}")).cast("double"), F.lit(0.0)) for e in ("first", "last")}
    told = ends | {"name_exact": whole("name"), "addr_exact": whole("addr"), "name_prefix4_match": equal("prefix4")} | {f"addr_{f}_match": equal(f) for f in PATTERNS}
    told |= country_features()
    sides = [f"{k}_{side}_{what}" for k in ("s1", "cand") for side in ("name", "addr") for what in ("is", "len", "counts", "words")]
    used = sorted(set().union(*map(_looked_at, trees)))

    def run(batches):
        for pdf in batches:
            low, high = bounds(pdf)
            sure = np.ones(len(pdf), bool)
            for tree in trees:
                least, most = reached(tree, low, high)
                sure &= most - least <= EQUAL
            yield pdf[["s1_id", "cand_id", "n_cands"]].assign(seen=list(low[:, used]), sure=sure)

    ready = met.select("s1_id", "cand_id", "n_cands", *sides, *(x.alias(f) for f, x in told.items()))
    return ready.mapInPandas(run, "s1_id string, cand_id string, n_cands long, seen array<float>, sure boolean")


def spread(seen: DataFrame, trees: list) -> DataFrame:
    """bounded_features as a column a feature; what the trees don't look at is 0."""
    used = {f: i for i, f in enumerate(sorted(set().union(*map(_looked_at, trees))))}
    return seen.select("s1_id", "cand_id", *((F.get("seen", F.lit(used[i])) if i in used else F.lit(0.0).cast("float")).alias(f) for f, i in PLACE.items()))
