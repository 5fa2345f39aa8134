"""Exact BM25 top-k search over shards of an inverted index, pruned by block-max WAND.

The index is built once, in one pass over the texts: each task writes shards of at most SHARD documents
or POSTINGS postings, with postings by term and document, and the documents of a shard in an order that
keeps like ones together. Global statistics (documents, mean length, document frequencies) are counted
over the whole index, so all shards score alike and the shards' best k merge to the exact best k.

In a block of BLOCK documents each list has a cell, with its largest gain. A block whose maxima together stay
below the least score that still matters to a query is skipped by all the query's lists. Cells of many of the
block's documents stand in a table, and give what they give as one product for TOGETHER queries. The others stand
by falling idf. The pivot is the first from which all that follow, together with the most that the table gave,
stay below the least score: a document in none of the lists before it can't reach that score. Lists before the
pivot are read; those after it along with them, which saves a second look, unless they hold most of the postings;
then they are read only if many documents are left. What can still reach the least score is scored whole, from its
own terms. What is read is held as single floats, whose error the bounds allow for; answers are scored in doubles.
The least score is the k-th best so far: of a sample of shards first, then of the task's shards before, then of
what the block's lists already give. Equal texts are indexed once, with the number of their rows, and asked once;
their rows share the answers.

Queries are rows of the table itself, whole texts, each distinct term once; a document isn't its own
answer, equal texts are. They are answered in blocks of about QUERIES queries and TERMS terms, one after
the other against all shards; a block alone is on the driver and in the tasks. Ties: scores are rounded
to 6 digits, then the smaller doc_id is first. Null or empty text: no terms, no answers, and never an answer.
Repeated rows: each counts in the statistics; answers are k distinct doc_ids, one of several texts by its best, a
query of several texts by the smallest. Null doc_id: counted in the statistics, neither query nor answer. Very
long texts: whole. Extra columns are left out. Empty table: no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.llm.common import blocks, materialize, shared_dir, small_batches, table

K1, B = 1.2, 0.75
TOP_K, QUERIES, TERMS = 10, 8192, 4_000_000
#: Documents and postings of a shard, documents of a block; one shard in SAMPLED gives the first least scores.
SHARD, POSTINGS, BLOCK, SAMPLED = 8192, 2_000_000, 1024, 16
#: A list of one in LONG of a block's documents or more stands in the block's table; so many queries meet it at a time.
LONG, TOGETHER = 16, 256
#: So many documents of a block are scored whole at once, without a look at the lists after the pivot.
FEW = 4
#: Documents of a shard, and queries of a block, are put together by so many kinds of frequent terms at most.
KINDS = 8
#: Lists after the pivot are read along with those before it if all of them hold at most so many times the postings of those before it.
MOSTLY = 8
#: Texts of several rows up to so many are broadcast by their hashes; more are shuffled to the texts.
SENT = 500_000
#: Scores are compared rounded to 6 digits: one that is lower by less than this may round to the same.
SLACK = 1e-6
_U = np.uint64
INDEX = "shard long, names binary, first binary, doc binary, tf binary, words binary, ids array<long>, many binary"


def term_counts(texts):
    """For each text (sorted distinct term hashes, their counts, number of words)."""
    for _, _, block in blocks(texts, lower=True):
        block.words()
        h = block.hash_words()
        first = block.first.tolist()
        for a, b in zip(first[:-1], first[1:], strict=True):
            names, n = np.unique(h[a:b], return_counts=True)
            yield names, n, b - a


def _spans(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places from each first to its end."""
    n = end - first
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def _narrow(x: np.ndarray) -> bytes:
    """Numbers in 1, 2 or 4 bytes each, as the largest needs; _wide reads them by how many there are."""
    most = int(x.max(initial=0))
    return x.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


def _wide(x, n: int) -> np.ndarray:
    return np.frombuffer(x, f"<u{len(memoryview(x)) // n}") if n else np.empty(0, np.uint8)


def alike(doc: np.ndarray, term: np.ndarray, words: np.ndarray) -> np.ndarray:
    """An order of texts, given as postings (text, term), that puts texts of the same frequent terms together, by length: languages fall apart."""
    n = len(words)
    df = np.bincount(term)
    often = df[term] * 64 >= n
    doc, term = doc[often], np.unique(term[often], return_inverse=True)[1]
    v = int(term.max(initial=-1)) + 1
    left, kind = np.ones(n, bool), np.full(n, -1)
    for c in range(KINDS):  # each kind begins as what holds the most frequent term of what is left
        mine = left[doc]
        if not mine.any():
            break
        count = np.bincount(term[mine], minlength=v)
        first = int(count.argmax())
        if 64 * count[first] < n:
            break
        has = doc[term == first]
        has = has[left[has]]
        left[has], kind[has] = False, c
    kinds = int(kind.max(initial=-1)) + 1
    if kinds > 1:  # and then takes what is likelier with its terms
        at, held = kind[doc], []
        for c in range(kinds):
            count = np.bincount(term[at == c], minlength=v) + 0.1
            held.append(np.bincount(doc, np.log(count / count.sum())[term], n))
        kind = np.argmax(held, axis=0)
    return np.lexsort((words, kind))


def build_shard(ids: list, docs: list[tuple], many: list | None = None) -> dict[str, object]:
    """The columns of a shard; docs as from term_counts; many: how many rows each stands for."""
    n = len(docs)
    doc = np.repeat(np.arange(n, dtype=np.int32), [len(d[0]) for d in docs])
    names, term, df = np.unique(np.concatenate([d[0] for d in docs]), return_inverse=True, return_counts=True)
    term, tf = term.astype(np.int32), np.concatenate([d[1] for d in docs])
    words = np.array([d[2] for d in docs], np.int64)
    order = alike(doc, term, words)  # so that block maxima are close to what their documents reach
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    doc = place[doc]
    by_term = np.lexsort((doc, term))
    return {
        "names": names.tobytes(), "first": np.concatenate([[0], np.cumsum(df)]).astype("<u4").tobytes(), "doc": _narrow(doc[by_term]),
        "tf": _narrow(tf[by_term]), "words": words[order].astype("<u4").tobytes(), "ids": [ids[i] for i in order.tolist()],
    } | ({} if many is None else {"many": np.array(many, "<u4")[order].tobytes()})


def build_index(docs: DataFrame) -> DataFrame:
    """INDEX rows, one a shard, of (doc_id, text, many)."""

    def run(batches):
        at, made = TaskContext.get().partitionId() << 24, 0
        ids, held, many, postings = [], [], [], 0

        def flush():
            return pa.RecordBatch.from_pylist([{"shard": at + made} | build_shard(ids, held, many)], schema)

        schema = pa.schema([("shard", pa.int64()), *((c, pa.binary()) for c in ("names", "first", "doc", "tf", "words")), ("ids", pa.list_(pa.int64())), ("many", pa.binary())])
        for batch in batches:
            for i, d, n in zip(batch.column(0).to_pylist(), term_counts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                if held and (len(held) == SHARD or postings + len(d[0]) > POSTINGS):
                    yield flush()
                    made += 1
                    ids, held, many, postings = [], [], [], 0
                ids.append(i)
                held.append(d)
                many.append(n)
                postings += len(d[0])
        if held:
            yield flush()

    return docs.select("doc_id", "text", "many").mapInArrow(run, INDEX)


def _named(text):
    """Equal texts by 128 bits; null: an empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def copies_of(docs: DataFrame, k: int) -> DataFrame:
    """(h, doc_id, n, ids): each text of several rows, its smallest doc_id, its rows, its k smallest ids. Texts with an id that other rows have as well are left out: their rows stand for themselves."""
    named = materialize(docs.select("doc_id", _named(F.col("text")).alias("h")))
    known = named.where("doc_id is not null")
    several = named.groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n > 1 and doc_id is not null")
    repeated = known.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    first = known.withColumn("rank", F.row_number().over(W.partitionBy("h").orderBy("doc_id"))).where(F.col("rank") <= k)
    first = first.groupBy("h").agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))
    return materialize(several.join(first, "h").join(known.join(repeated, "doc_id").select("h").distinct(), "h", "left_anti"))


def _once(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """(doc_id, text, many): one row for each text of `copies`, all other rows as they are."""
    few = copies.select("h", F.col("doc_id").alias("first"), F.col("n").alias("many"))
    few = few.hint("broadcast" if copies.count() <= SENT else "shuffle_hash")
    return docs.withColumn("h", _named(F.col("text"))).join(few, "h", "left").where("first is null or doc_id = first").select("doc_id", "text", F.coalesce("many", F.lit(1)).alias("many"))


class Shard:
    """One shard, scored by the global mean length; a term's idf is the query's. Its lists are cut into blocks of documents; a list's part in a block is a cell."""

    def __init__(self, names, first, doc, tf, words, ids, mean: float, block: int = BLOCK):
        self.block = block
        self.names, first = np.frombuffer(names, _U), np.frombuffer(first, "<u4").astype(np.int64)
        doc, tf = (_wide(x, int(first[-1])) for x in (doc, tf))
        ids = ids if isinstance(ids, pa.Array) else pa.array(ids, pa.int64())
        self.known, self.ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        n, v = len(self.ids), len(self.names)
        self.norm = K1 * (1 - B + B * np.frombuffer(words, "<u4") / mean)
        term = np.repeat(np.arange(v, dtype=np.int32), np.diff(first))
        # The documents' own terms, in the order of the terms' names in every shard.
        by_doc = np.argsort(doc, kind="stable")
        self.own_term, self.own_tf = term[by_doc], tf[by_doc]
        del by_doc
        self.doc_at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
        self.weight = np.zeros(v)  # idf of the query's terms, else 0
        gain = self.norm.astype(np.float32).take(doc)
        gain += tf
        np.divide(tf * np.float32(K1 + 1), gain, gain)
        # Block by block: each cell's largest gain, its row in the table if it holds many of the block's documents, else where its postings are.
        self.n_blocks = -(-n // block)
        self.cell_max = np.zeros((self.n_blocks, v), np.float32)
        self.row = np.full((self.n_blocks, v), -1, np.int32)
        self.at = np.zeros((self.n_blocks, v + 1), np.int32)
        self.posting, self.tables = [], []
        for b in range(self.n_blocks):
            width = min(block, n - b * block)
            mine = (doc >= b * block) & (doc < b * block + width)
            t, g, d = term[mine], gain[mine], doc[mine]
            del mine
            if b + 1 == self.n_blocks:
                del term, gain, doc
            d = d.astype(np.float32)
            d -= b * block
            size = np.bincount(t, minlength=v)
            start = np.cumsum(size) - size
            some = np.flatnonzero(size)
            if len(some):
                self.cell_max[b, some] = np.maximum.reduceat(g, start[some])
            often = np.flatnonzero(size * LONG >= max(width, 64))
            self.row[b, often] = np.arange(len(often))
            rows = np.zeros((len(often), width), np.float32)
            for r, (x, y) in enumerate(zip(start[often].tolist(), (start + size)[often].tolist(), strict=True)):
                rows[r, d[x:y].astype(np.intp)] = g[x:y]
            self.tables.append(rows)
            del start, some
            size[often] = 0
            np.cumsum(size, out=self.at[b, 1:])
            short = self.row[b].take(t) < 0
            # Document and gain side by side in 8 bytes, so that a posting is one look into memory.
            held = np.empty((int(self.at[b, -1]), 2), np.float32)
            held[:, 0], held[:, 1] = d[short], g[short]
            self.posting.append(held.view(_U)[:, 0])
            del t, g, d, short
        self.error = (max((len(x) for x in self.tables), default=0) + 8) * 2.0**-22  # of a sum of single floats, as a share of it
        assert n <= 1 << 24, "a document's place is held as a single float"

    @property
    def table(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.tables]) if self.tables else np.empty(0, np.float32)

    def search(self, term: np.ndarray, idf: np.ndarray, k: int, least: float, but: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """search_all for one query."""
        for _, ids, score in self.search_all(term, idf, np.array([0, len(term)]), k, np.array([least]), [but]):
            return ids, score
        return np.empty(0, np.int64), np.empty(0)

    def search_all(self, term: np.ndarray, idf: np.ndarray, first: np.ndarray, k: int, least: np.ndarray, but: list):
        """For queries side by side, (query, ids, scores rounded) of the documents that may be among the k best distinct ids and reach `least`; never the id in `but`.

        term: places in names; first: where each query's terms begin, best with the rarest first.
        """
        least = np.maximum(0.0, least - SLACK)  # what rounds to the same score isn't lost
        owner = np.repeat(np.arange(len(least)), np.diff(first))
        found = [[] for _ in least]
        for b in range(self.n_blocks):
            for q, places in self._block(b, term, idf, owner, k, least, but):
                found[q].append(places)
        for q, places in enumerate(found):
            if not places:
                continue
            places = np.concatenate(places)
            mine = slice(first[q], first[q + 1])
            self.weight[term[mine]] = idf[mine]
            size = self.doc_at[places + 1] - self.doc_at[places]
            own = _spans(self.doc_at[places], self.doc_at[places + 1])
            tf = self.own_tf.take(own).astype(float)
            gains = tf * (K1 + 1) / (np.repeat(self.norm[places], size) + tf) * self.weight.take(self.own_term.take(own))
            self.weight[term[mine]] = 0
            score = np.add.reduceat(gains, np.cumsum(size) - size)
            ok = score >= least[q]
            if ok.any():
                yield q, self.ids[places[ok]], np.round(score[ok], 6)

    def _block(self, b: int, term: np.ndarray, idf: np.ndarray, owner: np.ndarray, k: int, least: np.ndarray, but: list):
        """(query, places) of a block's documents that may reach `least`, which rises with what they have."""
        over, many = 1 + self.error, len(least)  # a sum times this, and a little, is no less than what it stands for
        # A block whose maxima together stay below a query's least score is skipped by all its lists.
        most = self.cell_max[b].take(term)
        here = np.flatnonzero(most)
        q = owner[here]
        bound = idf[here] * most[here]
        alive = np.bincount(q, bound, many) * over + 1e-9 >= np.maximum(least, 1e-8)
        if not alive.any():
            return
        if not alive.all():
            keep = alive[q]
            here, q, bound = here[keep], q[keep], bound[keep]
        live = np.flatnonzero(alive)
        q = (np.cumsum(alive) - 1)[q]
        term, idf, floor, many = term[here], idf[here], least[live], len(live)
        # What the cells in the table give, for all queries and documents as one product.
        row, table = self.row[b].take(term), self.tables[b]
        long = row >= 0
        weight = np.zeros((many, len(table)), np.float32)
        weight[q[long], row[long]] = idf[long]
        used = weight.any(0)
        has = weight @ table if 4 * used.sum() > 3 * len(table) else weight[:, used] @ table[used]
        top = has.max(1).astype(float)
        short = ~long
        term, idf, bound, q = term[short], idf[short], bound[short], q[short]
        # The pivot: what is in none of the lists before it, but in all after it and the table's, stays below the least score.
        all_of = np.bincount(q, bound, many)
        after = top[q] + np.cumsum(all_of)[q] - np.cumsum(bound) + bound
        head = after * over + 1e-6 >= floor[q]
        begin = self.at[b].take(term).astype(np.int64)
        size = self.at[b].take(term + 1) - begin
        # Lists after the pivot are read along, which saves a second look, unless they hold most of the postings.
        along = MOSTLY * np.bincount(q, size * head, many) >= np.bincount(q, size, many)
        read = head | along[q]
        read &= ((top + all_of) * over + 1e-6 >= floor)[q]
        rest = np.where(along, 0.0, all_of - np.bincount(q, bound * head, many))
        width = table.shape[1]

        def add(has, read):  # what the lists read give
            n = size[read]
            both = self.posting[b].take(_spans(begin[read], begin[read] + n)).view(np.float32).reshape(-1, 2)
            at = both[:, 0].astype(np.intp)
            at += np.repeat(q[read] * width, n)
            return np.bincount(at, both[:, 1] * np.repeat(idf[read].astype(np.float32), n), many * width).reshape(many, width) + has

        def reach(has):
            return np.flatnonzero(has >= np.maximum((floor - 1e-6) / over - rest, 1e-12)[:, None])

        has = add(has, read)
        near = reach(has)
        again = (rest > 0) & (np.bincount(near // width, minlength=many) > FEW)
        if again.any():  # many are left: the other lists are read as well, before documents are scored whole
            has = add(has, again[q] & ~read)
            rest[again] = 0
            near = reach(has)
        if not len(near):
            return
        of, near = near // width, near % width + b * self.block
        known = self.known[near]
        of, near = of[known], near[known]
        edge = np.searchsorted(of, np.arange(many + 1))
        for i in np.flatnonzero(np.diff(edge)).tolist():
            g, places = int(live[i]), near[edge[i] : edge[i + 1]]
            if but[g] is not None:
                places = places[self.ids[places] != but[g]]
            # The k-th best of distinct ids by what they have already is a least score as well.
            if len(places) > k:
                mine = has[i].take(places - b * self.block)
                reached = self._reached(np.arange(len(places)), mine, k, places) * (1 - 2 * self.error) - SLACK
                if reached > least[g]:
                    least[g] = reached
                    places = places[mine + rest[i] >= (reached - 1e-6) / over]
            if len(places):
                yield g, places

    def _reached(self, found: np.ndarray, has: np.ndarray, k: int, places: np.ndarray) -> float:
        """The k-th largest of `has` over distinct ids of the documents at `places`; 0 if there are fewer."""
        many = 2 * k
        while len(found) >= k:
            some = found if len(found) <= many else found[np.argpartition(-has[found], many - 1)[:many]]
            some = some[np.argsort(-has[some], kind="stable")]
            _, once = np.unique(self.ids[places[some]], return_index=True)
            if len(once) >= k:
                return float(has[some[np.sort(once)[k - 1]]])
            if len(some) == len(found):
                break
            many *= 4
        return 0.0


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best distinct ids: by score, then by id."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, once = np.unique(ids, return_index=True)
    keep = np.sort(once)[:k]
    return ids[keep], scores[keep]


class Asked:
    """A block of queries: the terms of all, with their idf, and each query's as places among them, the rarest first. Like queries stand together."""

    def __init__(self, ids: list, size: np.ndarray, terms: np.ndarray, names: np.ndarray, df: np.ndarray, n: int):
        """size: of each query's terms, which stand one query after the other; names: all terms, sorted, with their frequencies."""
        self.names, self.idf = names, np.log1p((n - df + 0.5) / (df + 0.5))
        at = np.searchsorted(names, terms).astype(np.int32)
        owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
        order = alike(owner, at, size)
        place = np.empty(len(size), np.int32)
        place[order] = np.arange(len(size), dtype=np.int32)
        self.ids = [ids[i] for i in order.tolist()]
        self.at = at[np.lexsort((-self.idf.astype(np.float32)[at], place[owner]))]
        self.first = np.concatenate([[0], np.cumsum(size[order])]).astype(np.int64)


def answer(index: DataFrame, asked: Asked, mean: float, k: int, least: np.ndarray) -> DataFrame:
    """(query_id, doc_id, score): the k best of each task's shards, for the queries of a block."""
    sent = index.sparkSession.sparkContext.broadcast((asked, least))

    def run(batches):
        asked, least = sent.value
        least, best = least.copy(), {}
        shard = None
        for batch in batches:
            for row in range(batch.num_rows):
                shard = None  # one at a time
                shard = Shard(*(batch.column(c)[row].as_buffer() for c in range(1, 6)), batch.column(6)[row].values, mean, BLOCK)
                place = np.minimum(np.searchsorted(shard.names, asked.names), len(shard.names) - 1) if len(shard.names) else np.zeros(len(asked.names), np.int64)
                place[shard.names[place] != asked.names if len(shard.names) else slice(None)] = -1
                place = place.astype(np.int32)
                for begin in range(0, len(asked.ids), TOGETHER):
                    end = min(begin + TOGETHER, len(asked.ids))
                    at = asked.at[asked.first[begin] : asked.first[end]]
                    term = place.take(at)
                    here = term >= 0
                    first = np.append(0, np.cumsum(here))[asked.first[begin : end + 1] - asked.first[begin]]
                    for q, found, score in shard.search_all(term[here], asked.idf.take(at[here]), first, k, least[begin:end], [None] * (end - begin)):
                        q += begin
                        if q in best:
                            found, score = np.concatenate([best[q][0], found]), np.concatenate([best[q][1], score])
                        best[q] = found, score = best_of(found, score, k)
                        if len(found) == k:
                            least[q] = max(least[q], score[-1])
        of = [np.full(len(x[0]), asked.ids[q], np.int64) for q, x in best.items()]
        parts = [np.concatenate(x) if x else np.empty(0, t) for x, t in ((of, np.int64), ([x[0] for x in best.values()], np.int64), ([x[1] for x in best.values()], float))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts], ["query_id", "doc_id", "score"])

    return index.mapInArrow(run, "query_id long, doc_id long, score double")


def merged(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, doc_id, score)."""
    once = found.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    first = W.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id")
    return once.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def _terms(queries: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = [x[0].view(np.int64) for x in term_counts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "terms"])

    return queries.mapInArrow(run, "doc_id long, terms array<long>").where("size(terms) > 0")


def _frequencies(index: DataFrame) -> DataFrame:
    """(term, df) over the index."""

    def run(batches):
        for batch in batches:
            for names, first, doc, many in zip(*batch.columns, strict=True):
                first, many = np.frombuffer(first.as_py(), "<u4").astype(np.int64), np.frombuffer(many.as_py(), "<u4")
                df = np.diff(first)
                if len(df) and many.max() > 1:
                    df = np.add.reduceat(many.astype(np.int64)[_wide(doc.as_py(), int(first[-1]))], first[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(names.as_py(), np.int64)), pa.array(df)], ["term", "df"])

    return index.select("names", "first", "doc", "many").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _totals(index: DataFrame) -> tuple[int, int]:
    def run(batches):
        n = words = 0
        for batch in batches:
            for x, many in zip(*batch.columns, strict=True):
                many = np.frombuffer(many.as_py(), "<u4").astype(np.int64)
                n, words = n + int(many.sum()), words + int(np.frombuffer(x.as_py(), "<u4") @ many)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([words])], ["n", "words"])

    r = index.select("words", "many").mapInArrow(run, "n long, words long").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    return r["n"] or 0, r["words"] or 0


def search(docs: DataFrame, k: int = TOP_K, every: int = 50) -> DataFrame:
    """(query_id, rank, doc_id, score): for each row whose doc_id is divisible by `every`, the k best others."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    more = k + 1  # a query's own row is among its answers till the end
    copies = copies_of(docs, more)
    index = materialize(build_index(_once(docs, copies)))
    chosen = materialize(docs.where(F.col("doc_id") % every == 0).groupBy("doc_id").agg(F.min("text").alias("text")).withColumn("h", _named(F.col("text"))))
    of = materialize(chosen.select(F.col("doc_id").alias("query_id"), "h").join(chosen.groupBy("h").agg(F.min("doc_id").alias("asked")), "h").select("query_id", "asked"))
    queries = materialize(_terms(chosen.join(of.select(F.col("asked").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "text")))
    n, words = _totals(index)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # a row is a shard
    many, terms = queries.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    if not words or not many:
        small_batches(spark)
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    parts = max(1, -(-many // QUERIES), -(-terms // TERMS))
    # A block's distinct terms meet their frequencies once, so a frequent term is a row a block.
    dealt = queries.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    vocabulary = dealt.select("part", F.explode("terms").alias("term")).distinct().join(_frequencies(index), "term")
    vocabulary, dealt = (materialize(x.repartition("part") if parts > 1 else x) for x in (vocabulary, dealt))
    out = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    least_shard = index.agg(F.min("shard")).first()[0]
    sample = index.where((F.pmod(F.xxhash64("shard"), F.lit(SAMPLED)) == 0) | (F.col("shard") == least_shard))
    for part in range(parts):
        asked = _asked(dealt, vocabulary, part, n)
        first = merged(answer(sample, asked, words / n, more, np.zeros(len(asked.ids))), more)
        reached = {r["query_id"]: r["least"] for r in first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == more).collect()}
        least = np.array([reached.get(q, 0.0) for q in asked.ids])
        merged(answer(index, asked, words / n, more, least), more).write.mode("append").parquet(out)
    small_batches(spark)
    return _expanded(spark.read.parquet(out), copies, of, k)


def _expanded(found: DataFrame, copies: DataFrame, of: DataFrame, k: int) -> DataFrame:
    """Answers of distinct texts to distinct texts, as answers of all rows to all queries: the k + 1 best of a text hold the k best others of each of its rows."""
    all_ids = found.join(copies.select("doc_id", "ids"), "doc_id", "left").select("query_id", F.explode(F.coalesce("ids", F.array("doc_id"))).alias("doc_id"), "score")
    best = merged(all_ids, k + 1).select(F.col("query_id").alias("asked"), "doc_id", "score")
    return merged(of.join(best, "asked").where("doc_id <> query_id").select("query_id", "doc_id", "score"), k)


def _asked(dealt: DataFrame, vocabulary: DataFrame, part: int, n: int) -> Asked:
    """A block of queries on the driver, of about QUERIES queries and TERMS terms at most, as arrays from end to end."""
    small_batches(dealt.sparkSession)
    words = vocabulary.where(F.col("part") == part).select("term", "df").toArrow()
    names, df = words["term"].to_numpy().view(_U), words["df"].to_numpy().astype(float)
    del words
    order = np.argsort(names)
    rows = dealt.where(F.col("part") == part).select("doc_id", "terms").toArrow()
    dealt.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lists = [x for x in rows["terms"].chunks if len(x)]
    size = np.concatenate([np.diff(x.offsets.to_numpy()) for x in lists] or [np.empty(0, np.int64)]).astype(np.int64)
    terms = np.concatenate([x.flatten().to_numpy().view(_U) for x in lists] or [np.empty(0, _U)])
    ids = rows["doc_id"].to_pylist()
    del rows, lists
    return Asked(ids, size, terms, names[order], df[order], n)


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"))
