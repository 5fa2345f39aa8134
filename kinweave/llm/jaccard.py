"""Exact Jaccard self-join of shingle sets by prefixes under several global token orders.

Two sets of sizes a and b that are similar enough share a token among the first
n - ceil(t * n) + 1 of either, under any one order of all tokens. The first order is by frequency in
the corpus, rare first, from a counting sketch of a fixed size filled over all documents (any order is
valid, so the sketch's error costs work and no link); its prefix tokens are the keys that bring
documents together. Two further orders are by hashes of the token. The pairs found must share a prefix
token under each of them as well: prefixes are compared, and the pairs of all filters intersected, before
whole sets are sent. Sets are made only for pairs whose bit maps, one parity bit a token, don't already
show more differences than a link allows.

Links are wanted as components, so a group of documents that share a key isn't expanded into its
pairs. Equal sets are one entity. Each group first compares its members with one hub, the member with
the smallest share of rare tokens, which in a group of near copies is the one closest to all others;
groups of frequent keys are split by a hash of the member, with a hub each, and the hubs compared
again. Only groups that then still hold members of different components compare members across
components, within the bounds on sizes and positions, so no link between different components is lost.
There the members outside of a group's largest component meet all others, both sides in parts of PART
members, so a large group is many small ones.

Null or empty text, or no words: the empty set, linked with nothing, its own component. Fewer words
than a shingle: the whole sequence is the one shingle. Repeated rows and ties: equal sets are linked, and
so are the rows of one doc_id if their texts are, and only then. Very long texts: whole. Null doc_id: a
document like others, which gives its component no id; component_id is null where no document has one.
Extra columns are left out. Empty table: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.llm.common import LABEL_SALTS, SKETCH_BLOCKS, blocks, bloom_bits, bloom_has, bloom_of, components, discard, fold_blocks, fresh, gather_blocks, materialize, mix, rolling, small_batches, table

WORDS = 5
#: Similarity as a fraction.
NUM, DEN = 3, 4
CELLS = 1 << 22
#: Keys in so many documents more than the sketch's mean are split, a hub for about so many of them; members that meet across components, on either side of a part.
HOT, PART = 2000, 512
_U = np.uint64
_ORDERS = (_U(0x51ED270B7A1F3C4D), _U(0xA24BAED4963EE407))


def shingle_sets(texts, words: int = WORDS):
    """For each text its distinct shingles' hashes, sorted."""
    for _, _, block in blocks(texts, lower=True):
        block.words()
        h = block.hash_words()
        rolled = rolling(h, words)
        first = block.first.tolist()
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= words:
                yield np.unique(rolled[a : b - words + 1])
            elif b > a:
                # The length keeps a short sequence apart from shingles.
                yield mix(rolling(h[a:b], b - a) + _U(b - a))
            else:
                yield np.empty(0, _U)


def prefix_length(n: int) -> int:
    return n - -(-n * NUM // DEN) + 1


def prefix(h: np.ndarray, order: int) -> np.ndarray:
    """The prefix of a set under one of the hash orders."""
    p = prefix_length(len(h))
    if p >= len(h):
        return h
    return h[np.argpartition(mix(h ^ _ORDERS[order]), p - 1)[:p]]


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets, sorted, link."""
    small, large = sorted((len(a), len(b)))
    if not small or DEN * small < NUM * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def short_prefix(h: np.ndarray, order: int) -> np.ndarray:
    """The prefix under a further order as sorted 32-bit names: equal tokens have equal ones."""
    return np.sort((prefix(h, order) >> _U(32)).astype(np.uint32))


def share(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted arrays have a value in common."""
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(b, a)
    return bool((b[np.minimum(at, len(b) - 1)] == a).any())


def parity(h: np.ndarray) -> bytes:
    """A bit map with the parity of the set's tokens in each place: a power of two of places, one or more a token and 512 at least."""
    size = 512
    while size < len(h):
        size *= 2
    bits = np.bincount((mix(h ^ _U(0x2545F4914F6CDD1D)) & _U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def may_link(a: bytes, n: int, b: bytes, m: int) -> bool:
    """Whether two bit maps differ in no more places than two sets that link can differ in tokens. The larger map is folded."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    # With an overlap of at least NUM / (NUM + DEN) of both sizes together, this many tokens are in one set only.
    return (NUM + DEN) * int(np.bitwise_count(x ^ y).sum()) <= (DEN - NUM) * (n + m)


def folded(bits: bytes) -> np.ndarray:
    """A bit map folded to eight longs."""
    x = np.frombuffer(bits, np.uint64)
    while len(x) > 8:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.view(np.int64)


def _ids(batch):
    return batch.column(0).to_pylist(), batch.column(1)


FIRST = "block int, cells binary, doc_id long, n int, fp1 long, fp2 long"


def _print(h: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    return (int(h.sum(dtype=_U)) - 2**63, int(mix(h).sum(dtype=_U)) - 2**63) if len(h) else (0, 0)


def first_pass(docs: DataFrame) -> DataFrame:
    """FIRST rows: of each document its set's size and 128 bits of it; of each task its counts of documents per cell of the tokens' hashes."""
    width = CELLS // SKETCH_BLOCKS

    def run(batches):
        cells = np.zeros(CELLS, "<u4")
        for batch in batches:
            ids, texts = _ids(batch)
            held = list(shingle_sets(texts))
            if held:
                np.add.at(cells, (np.concatenate(held) & _U(CELLS - 1)).astype(np.int64), 1)
            prints = [_print(h) for h in held]
            none = pa.nulls(len(ids), pa.int32())
            yield pa.RecordBatch.from_arrays([none, pa.nulls(len(ids), pa.binary()), pa.array(ids, pa.int64()), pa.array([len(h) for h in held], pa.int32()), pa.array([x[0] for x in prints], pa.int64()), pa.array([x[1] for x in prints], pa.int64())], ["block", "cells", "doc_id", "n", "fp1", "fp2"])
        for k in range(SKETCH_BLOCKS):
            part = cells[k * width : (k + 1) * width]
            if part.any():
                none = pa.nulls(1, pa.int64())
                sent = part.astype(np.uint8) if part.max() < 256 else part  # most tasks need a byte a cell
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([sent.tobytes()], pa.binary()), none, pa.nulls(1, pa.int32()), none, none], ["block", "cells", "doc_id", "n", "fp1", "fp2"])

    return docs.select("doc_id", "text").mapInArrow(run, FIRST)


def frequency_sketch(first: DataFrame) -> np.ndarray:
    """Documents per cell; a cell stops at 2 ** 32 - 1 of them."""
    rows = first.where("block is not null").select("block", "cells")
    width = CELLS // SKETCH_BLOCKS
    total = fold_blocks(rows, lambda x: np.frombuffer(x, np.uint8 if len(x) == width else "<u4").astype("<u4"), lambda a, b: np.minimum(a.astype(np.uint64) + b, 2**32 - 1).astype("<u4"))
    return gather_blocks(total, "<u4", CELLS)


def fingerprints(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(doc_id, n, fp1, fp2, tokens, salts, rare, bits, map8): set sizes, 128 bits of the set, its prefix in the first order, of the frequent keys at its end over how many hubs each is split, how many thousandths of the set are rare, its bit map, and that folded to eight longs."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    mean = float(sketch.mean())
    hot, few = mean + max(HOT, 6 * mean**0.5), mean + 4 * mean**0.5 + 2  # what other tokens of the cell add varies by the root of their number

    def run(batches):
        for batch in batches:
            ids, texts = _ids(batch)
            n, fp1, fp2, tokens, salts, rare, bits, map8 = [], [], [], [], [], [], [], []
            for h in shingle_sets(texts):
                n.append(len(h))
                for out, x in zip((fp1, fp2), _print(h), strict=True):
                    out.append(x)
                often = shared.value[(h & _U(CELLS - 1)).astype(np.int64)]
                order = np.lexsort((h, often))[: prefix_length(len(h))] if len(h) else []
                tokens.append(h[order].view(np.int64) if len(h) else np.empty(0, np.int64))
                many = often[order][often[order] >= hot] if len(h) else np.empty(0)
                salts.append((1 << np.ceil(np.log2(np.maximum(2.0, (many - mean) / HOT))).astype(np.int64)).astype(np.int32))
                rare.append(int(1000 * (often < few).mean()) if len(h) else 0)
                bits.append(parity(h))
                map8.append(folded(bits[-1]))
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
            at = np.cumsum([0, *map(len, tokens)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int32()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)), pa.array(salts, pa.list_(pa.int32())), pa.array(rare, pa.int32()), pa.array(bits, pa.binary()), pa.array(map8, pa.list_(pa.int64()))], ["doc_id", "n", "fp1", "fp2", "tokens", "salts", "rare", "bits", "map8"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n int, fp1 long, fp2 long, tokens array<long>, salts array<int>, rare int, bits binary, map8 array<long>")


def sizes_fit(a: str, b: str):
    return DEN * F.least(a, b) >= NUM * F.greatest(a, b)


def verify(pairs: DataFrame, docs: DataFrame, members: DataFrame) -> DataFrame:
    """Of (a, b) the pairs that link.

    The documents are read again for the sets of those in a pair that the bit maps let through; a Bloom
    filter over the doc_ids of their first documents keeps the rest from being read. The prefixes under
    the further orders meet first, then the whole sets of the pairs that share tokens in both.
    """

    def by_bits(batches):
        for batch in batches:
            x = batch.to_pydict()
            ok = [may_link(*y) for y in zip(x["p"], x["n"], x["q"], x["m"], strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    maps = members.select(F.col("ent").alias("a"), F.col("bits").alias("p"), "n")
    mapped = pairs.join(maps, "a").join(maps.toDF("b", "q", "m"), "b").select("a", "b", "p", "n", "q", "m")
    pairs = materialize(mapped.mapInArrow(by_bits, "a long, b long"))
    wanted = materialize(members.join(pairs.select(F.explode(F.array("a", "b")).alias("ent")).distinct(), "ent", "left_semi").select("ent", "rep", "fp1", "fp2"))
    seen = docs.sparkSession.sparkContext.broadcast(bloom_of(wanted, "rep", bloom_bits(wanted.count())))

    def sets(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            # Documents without an id aren't in the filter.
            has = bloom_has(seen.value, ids.fill_null(0).to_numpy(zero_copy_only=False).view(_U)) | ids.is_null().to_numpy(zero_copy_only=False) if len(ids) else np.empty(0, bool)
            out = list(shingle_sets(texts.filter(pa.array(has, pa.bool_()))))
            prints = [_print(h) for h in out]
            columns = [pa.array([x[0] for x in prints], pa.int64()), pa.array([x[1] for x in prints], pa.int64()), pa.array([h.tobytes() for h in out], pa.binary())]
            columns += [pa.array([short_prefix(h, k).tobytes() for h in out], pa.binary()) for k in range(len(_ORDERS))]
            yield pa.RecordBatch.from_arrays(columns, ["fp1", "fp2", "s", "o0", "o1"])

    held = docs.select("doc_id", "text").mapInArrow(sets, "fp1 long, fp2 long, s binary, o0 binary, o1 binary")
    held = materialize(held.join(wanted.select("fp1", "fp2", "ent"), ["fp1", "fp2"]).dropDuplicates(["ent"]).select("ent", "s", "o0", "o1"))

    def by_orders(batches):
        for batch in batches:
            x = [c.to_pylist() for c in batch.columns[2:]]
            ok = [all(share(np.frombuffer(y[k], np.uint32), np.frombuffer(y[2 + k], np.uint32)) for k in range(2)) for y in zip(*x, strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    orders = held.select(F.col("ent").alias("a"), "o0", "o1")
    pairs = pairs.join(orders, "a").join(orders.toDF("b", "q0", "q1"), "b").select("a", "b", "o0", "o1", "q0", "q1").mapInArrow(by_orders, "a long, b long")
    left = pairs.join(held.select(F.col("ent").alias("b"), F.col("s").alias("t")), "b")
    both = left.join(held.select(F.col("ent").alias("a"), "s"), "a").select("a", "b", "s", "t")

    def compare(batches):
        for batch in batches:
            s, t = batch.column(2), batch.column(3)
            ok = [links(np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)) for x, y in zip(s, t, strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    return both.mapInArrow(compare, "a long, b long")


def _across(known: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b) of different components that share a key and may link. known: (token, ent, n, pos, hot, label)."""
    by_label = known.groupBy("token", "label").agg(F.count("*").alias("c"), F.max("hot").alias("hot"))
    groups = by_label.groupBy("token").agg(F.max("hot").alias("hot"), F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("all"), F.max("c").alias("of_main"), F.count("*").alias("labels"))
    groups = groups.where("labels > 1").select("token", "main", "hot", F.ceil(F.col("all") / PART).cast("int").alias("parts"), F.ceil((F.col("all") - F.col("of_main")) / PART).cast("int").alias("few"))
    eight = members.select("ent", *(F.col("map8")[k].alias(f"m{k}") for k in range(8)))
    # A frequent key's members meet its row in parts.
    salts = F.when(F.col("hot"), F.sequence(F.lit(1), F.lit(LABEL_SALTS))).otherwise(F.array(F.lit(0)))
    parts = groups.withColumn("salt", F.explode(salts)).drop("hot")
    own_salt = F.when(F.col("hot"), 1 + F.pmod(F.xxhash64("ent", F.lit(1)), F.lit(LABEL_SALTS)).cast("int")).otherwise(0)
    rest = known.withColumn("salt", own_salt).drop("hot").join(parts, ["token", "salt"]).drop("salt").join(eight, "ent")
    # Members outside of the largest component, in `few` parts, meet all members, in `parts` parts.
    own = lambda n: F.pmod(F.xxhash64("ent"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = rest.where("label <> main").withColumn("i", own("few")).withColumn("j", each("parts")).alias("x")
    y = rest.withColumn("j", own("parts")).withColumn("i", each("few")).alias("y")
    # At the first key that two documents share, no more than what follows it in both can be common.
    room = 7 * F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= 3 * (F.col("x.n") + F.col("y.n"))
    differ = sum((F.bit_count(F.col(f"x.m{k}").bitwiseXOR(F.col(f"y.m{k}"))) for k in range(8)), F.lit(0))
    room = room & (7 * differ <= F.col("x.n") + F.col("y.n"))
    once = (F.col("y.label") == F.col("y.main")) | (F.col("x.ent") < F.col("y.ent"))
    same = (F.col("x.token") == F.col("y.token")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    met = x.join(y, same & (F.col("x.label") != F.col("y.label")) & once & sizes_fit("x.n", "y.n") & room)
    return met.select(F.least("x.ent", "y.ent").alias("a"), F.greatest("x.ent", "y.ent").alias("b")).distinct()


def groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, sets): a row (doc_id, n, fp1, fp2) for every document, and of each set that isn't empty (fp1, fp2, label, linked): the component of all links that it is in, and whether it has any link."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    first = materialize(first_pass(docs))
    prints = fingerprints(docs, frequency_sketch(first))
    # An entity's number is its own, whatever doc_ids its documents have; rep is the least of them.
    once = prints.where("n > 0").groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("tokens").alias("tokens"), *(F.first(x).alias(x) for x in ("salts", "rare", "bits", "map8")))
    members = materialize(once.withColumn("ent", F.monotonically_increasing_id()))
    keys = members.select("ent", "n", "salts", "rare", (F.size("tokens") - F.size("salts")).alias("cold"), F.posexplode("tokens").alias("pos", "token"))
    own = 1 + F.pmod(F.hash("ent"), F.get("salts", F.col("pos") - F.col("cold")))
    keys = keys.withColumn("salt", F.when(F.col("pos") >= F.col("cold"), own).otherwise(0)).drop("cold", "salts")
    group = W.partitionBy("token", "salt")
    early = group.orderBy("rare", "ent")
    met = keys.withColumns({"many": F.count("*").over(group), "hub": F.first("ent").over(early), "hub_n": F.first("n").over(early)})
    # A key of one document finds nothing; a split group's hub has others to meet, so it stays.
    met = materialize(met.where("many > 1 or salt > 0"))
    hubs = W.partitionBy("token").orderBy("rare", "ent")
    split = met.where("salt > 0 and ent = hub").withColumns({"hub": F.first("ent").over(hubs), "hub_n": F.first("n").over(hubs)})
    tried = met.select("hub", "hub_n", "ent", "n").union(split.select("hub", "hub_n", "ent", "n")).where("hub <> ent")
    tried = tried.where(sizes_fit("n", "hub_n")).select(F.least("hub", "ent").alias("a"), F.greatest("hub", "ent").alias("b")).distinct()
    tried = materialize(tried)
    found = materialize(verify(tried, docs, members))
    labels = components(found)

    # What the hubs didn't settle: keys whose documents are in different components.
    known = met.select("token", "ent", "n", "pos", (F.col("salt") > 0).alias("hot")).join(labels.withColumnRenamed("node", "ent"), "ent", "left").withColumn("label", F.coalesce("label", "ent"))
    known = materialize(known)
    across = materialize(_across(known, members).join(tried, ["a", "b"], "left_anti"))
    discard(known, met, tried)
    if not across.isEmpty():
        more = materialize(verify(across, docs, members))
        if not more.isEmpty():
            labels = components(found.union(more))

    label = labels.select(F.col("node").alias("ent"), "label")
    sets = materialize(members.select("fp1", "fp2", "ent").join(label, "ent", "left").select("fp1", "fp2", F.coalesce("label", "ent").alias("label"), F.col("label").isNotNull().alias("linked")))
    discard(members, found, across)
    return first.where("block is null").select("doc_id", "n", "fp1", "fp2"), sets


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document: the components of all links."""
    rows, sets = groups(docs)
    once = materialize(rows.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep")).join(sets, ["fp1", "fp2"]))
    # A set without links has its own least id; the others meet their component's in parts, as one component may hold most of them.
    linked = once.where("linked").withColumn("salt", F.pmod(F.xxhash64("fp1"), F.lit(LABEL_SALTS)).cast("int"))
    least = linked.groupBy("label").agg(F.min("rep").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    sets = linked.join(least, ["label", "salt"]).select("fp1", "fp2", "component_id").union(once.where("not linked").select("fp1", "fp2", "rep"))
    out = rows.join(sets, ["fp1", "fp2"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_similar(docs: DataFrame) -> DataFrame:
    """docs, all columns, with one document of each component: the one of the smallest doc_id (null last), of several rows of it the smallest text. Documents without words all stay.

    Documents whose id no component of several rows holds stay without a shuffle, by a Bloom filter; those that it lets through meet the chosen ones.
    """
    rows, sets = groups(docs)
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id")
    by_set = rows.where("n > 0").groupBy("fp1", "fp2").agg(F.min(order).alias("m"), F.count("*").alias("c"))
    labelled = materialize(by_set.select("fp1", "fp2", "m.null", "m.doc_id", "c").join(sets, ["fp1", "fp2"]))
    kept = labelled.groupBy("label").agg(F.min(F.struct("null", "doc_id", "fp1", "fp2")).alias("x")).select("x.fp1", "x.fp2", "x.doc_id")
    several = rows.join(labelled.where("linked or c > 1").select("fp1", "fp2"), ["fp1", "fp2"], "left_semi").where("doc_id is not null").select("doc_id").distinct()
    several = materialize(several)
    seen = docs.sparkSession.sparkContext.broadcast(bloom_of(several, "doc_id", bloom_bits(several.count())))
    one, two, of, rn = (fresh(docs, c) for c in ("set_print1", "set_print2", "kept_id", "row_of_id"))
    own = list(docs.schema)

    def meets(batch) -> np.ndarray:
        """Whether a row may be one of several: it has a word, and its id may be in the filter or is null."""
        if not batch.num_rows:
            return np.empty(0, bool)
        ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
        words = pc.match_substring_regex(texts, r"[^\x20\x09-\x0D]").fill_null(False).to_numpy(zero_copy_only=False)
        return words & (bloom_has(seen.value, ids.fill_null(0).to_numpy(zero_copy_only=False).view(_U)) | ids.is_null().to_numpy(zero_copy_only=False))

    def alone(batches):
        for batch in batches:
            yield batch.filter(pa.array(~meets(batch), pa.bool_()))

    def marked(batches):
        for batch in batches:
            batch = batch.filter(pa.array(meets(batch), pa.bool_()))
            prints = [_print(h) for h in shingle_sets(batch.column(batch.schema.get_field_index("text")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([x[k] for x in prints], pa.int64()) for k in (0, 1))], [*batch.schema.names, one, two])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own)
    asked = docs.mapInArrow(marked, f"{columns}, {one} long, {two} long")
    met = asked.join(kept.toDF(one, two, of), [one, two]).where(F.col("doc_id").eqNullSafe(F.col(of)))
    first = met.withColumn(rn, F.row_number().over(W.partitionBy(one, two).orderBy("text"))).where(F.col(rn) == 1)
    return first.select(*(F.col(f"`{f.name}`") for f in own)).unionByName(docs.mapInArrow(alone, columns))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))
