"""Removal of long word sequences that occur more than once, found by recompression.

Each text is a sequence of words, named by hash. A round first names maximal runs of one symbol
(symbol, length), then puts every symbol on one of two sides by a bit of its hash and names each
neighbouring pair (left, right). Names are hashes of what they stand for, so that all executors give
equal strings equal names without a shuffle. What a symbol depends on is kept with it: the words from
`lo` to `hi` alone decide that it stands there, so in every other occurrence of those words it stands
at the same place. Several rounds make a sequence about a third as long of symbols that are the same
inside of all copies of a passage.

A window of the wanted width owns the symbols whose words lo..hi it contains. Its anchor is the owned
symbol of the least hash; equal windows have equal anchors at equal places. Any window of 35 words that
holds a place holds the 17 words before it or the 17 after it, so an anchor is sent with the hashes of
both, as two keys; windows that own no symbol (inside of runs) are sent by themselves. Keys that occur
twice reveal the windows that may repeat; those are then compared by 95 bits of their words, which is
exact but for hash collisions. The documents are read again for it: a Bloom filter of a fixed size
over the repeated keys keeps all other windows from being sent.

Windows are judged on the input, not on what is left. Null or empty text: no words. Texts shorter than
a window lose nothing. Repeated rows: each is an occurrence, so long ones are removed whole. Very long
texts: whole. Extra columns pass through remove_repeats; own columns named n_words or n_removed are replaced.
Null or repeated doc_id: each row is a document. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.llm.common import _BASE, _BASE2, blocks, bloom_bits, bloom_has, bloom_of, fresh, materialize, mix, powers, small_batches, table

WIDTH, ROUNDS = 35, 4
_U = np.uint64
_RUN, _PAIR, _LEFT, _RIGHT, _BARE, _END = (_U(x) for x in (0xD6E8FEB86659FD93, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _join(a: np.ndarray, b: np.ndarray, kind: np.uint64) -> np.ndarray:
    return mix(mix(a ^ kind) * _U(3) + b)


def recompress(h: np.ndarray, rounds: int = ROUNDS):
    """(name, start, lo, hi) of the symbols after some rounds over word hashes; lo and hi (the last word) never fall along the sequence. At the text's ends a symbol depends on a place outside, -1 or len(h)."""
    n = len(h)
    name, start = h.copy(), np.arange(n)
    lo, hi = np.arange(n), np.arange(n)
    for r in range(rounds):
        if not len(name):
            break
        # Runs. Whether a symbol is in a run, and how long it is, its neighbours decide.
        begins = np.ones(len(name), bool)
        begins[1:] = name[1:] != name[:-1]
        at = np.flatnonzero(begins)
        size = np.diff(np.append(at, len(name)))
        first, last = at, at + size - 1
        lo2 = np.where(first > 0, lo[first - 1], -1)
        hi2 = np.where(last + 1 < len(name), hi[np.minimum(last + 1, len(name) - 1)], n)
        name = np.where(size > 1, _join(name[at], size.astype(np.uint64), _RUN), name[at])
        start, lo, hi = start[at], np.minimum(lo2, lo[first]), np.maximum(hi2, hi[last])
        # Pairs. A symbol of the left side followed by one of the right side: the two alone decide.
        side = (mix(name + _U(r)) & _U(1)).astype(bool)  # True: left
        m = len(name)
        heads = np.zeros(m, bool)
        heads[:-1] = side[:-1] & ~side[1:]
        tails = np.zeros(m, bool)
        tails[1:] = heads[:-1]
        before, after = np.concatenate([[-1], lo[:-1]]), np.append(hi[1:], n)
        single = ~heads & ~tails
        # A left symbol stays alone because of the one after it, a right one because of the one before.
        lo3 = np.where(single & ~side, np.minimum(lo, before), lo)
        hi3 = np.where(single & side, np.maximum(hi, after), hi)
        nxt = np.minimum(np.arange(m) + 1, m - 1)
        hi3 = np.where(heads, np.maximum(hi, hi[nxt]), hi3)
        lo3 = np.where(heads, np.minimum(lo, lo[nxt]), lo3)
        name = np.where(heads, _join(name, name[nxt], _PAIR), name)
        keep = ~tails
        name, start, lo, hi = name[keep], start[keep], lo3[keep], hi3[keep]
    return name, start, lo, hi


def _spans(total: np.ndarray, down: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))


class Parse:
    """The windows of a block of texts, their anchors, and the keys of the anchors.

    The texts' words stand in one sequence, with a symbol of its own after each text, so a symbol that
    depends on what is beyond a text's end belongs to no window.
    """

    def __init__(self, h: np.ndarray, first: np.ndarray, width: int = WIDTH, rounds: int = ROUNDS):
        """h: word hashes; first: the first word of each text, and the number of words."""
        self.width, texts = width, len(first) - 1
        n = len(h) + texts
        end = first[1:] + np.arange(texts)  # of each text, its own symbol's place
        self.begin = np.concatenate([[0], end[:-1] + 1]) if texts else np.empty(0, np.int64)
        own = np.zeros(n, bool)
        own[end] = True
        self.h = np.empty(n, np.uint64)
        self.h[~own] = h
        self.h[own] = mix(np.arange(texts, dtype=np.uint64) + _END)
        self.ends = np.zeros(n + 1, np.int64)  # texts' ends before each place
        np.cumsum(own, out=self.ends[1:])
        i = np.arange(max(0, n - width + 1))
        self.i = i = i[self.ends[i + width] == self.ends[i]]
        self.n_windows = w = len(i)
        if not w:
            return
        up, self.down = powers(_BASE, n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.h * up[:n], out=self.total[1:])
        name, start, lo, hi = recompress(self.h, rounds)
        first = np.searchsorted(lo, i, "left")
        last = np.searchsorted(hi, i + width - 1, "right") - 1  # first..last are owned
        owns = last >= first
        # The least hash among first..last, the leftmost of equal ones: a table of ranges of powers of two.
        back = np.argsort(mix(name), kind="stable")
        order = np.empty(len(name), np.int64)
        order[back] = np.arange(len(name))
        levels = [order]
        most = int((last - first).max()) + 1 if owns.any() else 0
        while 2 << (len(levels) - 1) <= most:
            step, x = 1 << (len(levels) - 1), levels[-1]
            levels.append(np.minimum(x[:-step], x[step:]))
        self.anchor = np.full(w, -1)
        level = np.log2(np.where(owns, last - first + 1, 1)).astype(int)
        for k in range(len(levels)):
            mine = np.flatnonzero(owns & (level == k))
            if len(mine):
                x = levels[k]
                self.anchor[mine] = back[np.minimum(x[first[mine]], x[last[mine] - (1 << k) + 1])]
        # Equal names in a window: their places within it are equal in all its copies, and so is the leftmost.
        mark = np.zeros(len(name), bool)
        mark[self.anchor[self.anchor >= 0]] = True
        self.used = used = np.flatnonzero(mark)
        self.of = np.cumsum(mark) - 1  # place of a symbol among the used ones
        at, half = start[used], width // 2
        left, right = np.maximum(at - half, 0), np.minimum(at + half + 1, n)
        in_left = (at >= half) & (self.ends[at + 1] == self.ends[left])
        in_right = (at + half < n) & (self.ends[right] == self.ends[at])
        self.lefts = np.where(in_left, mix(_spans(self.total, self.down, left, at + 1) ^ mix(name[used] ^ _LEFT)), _U(0))
        self.rights = np.where(in_right, mix(_spans(self.total, self.down, at, right) ^ mix(name[used] ^ _RIGHT)), _U(0))
        self.bare = np.flatnonzero(self.anchor < 0)
        self.at = start

    def windows(self, which: np.ndarray, base: int = _BASE) -> np.ndarray:
        """Hashes of windows, given as places in self.i."""
        i, n = self.i[which], len(self.h)
        if base == _BASE:
            return _spans(self.total, self.down, i, i + self.width)
        up, down = powers(base, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(self.h) * up[:n], out=total[1:])
        return _spans(total, down, i, i + self.width)

    def places(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, start within the text) of windows."""
        i = self.i[which]
        text = self.ends[i]
        return text, i - self.begin[text]

    def keys(self) -> np.ndarray:
        """Of all anchors, and of windows without one."""
        if not self.n_windows:
            return np.empty(0, np.uint64)
        found = np.concatenate([self.lefts, self.rights])
        return np.concatenate([found[found != 0], mix(self.windows(self.bare) ^ _BARE)])

    def candidates(self, has) -> np.ndarray:
        """Windows of which has(keys) holds for a key of the anchor within the window, or for the bare window."""
        if not self.n_windows:
            return np.empty(0, np.int64)
        half, ok = self.width // 2, np.zeros(self.n_windows, bool)
        owned = self.anchor >= 0
        if len(self.used):
            of = self.of[self.anchor[owned]]
            at = self.at[self.anchor[owned]] - self.i[owned]
            by_left = has(self.lefts) & (self.lefts != 0)
            by_right = has(self.rights) & (self.rights != 0)
            ok[owned] = ((at >= half) & by_left[of]) | ((at + half < self.width) & by_right[of])
        if len(self.bare):
            ok[self.bare] = has(mix(self.windows(self.bare) ^ _BARE))
        return np.flatnonzero(ok)


def parses(texts, width: int, rounds: int):
    """(first text's place in the batch, Parse) of each block."""
    for i, _, block in blocks(texts):
        block.words()
        yield i, Parse(block.hash_words(), block.first, width, rounds)


def repeated_windows(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """docs: (id, text); rows of one id have equal texts. (id, ats): first words of the windows that also stand elsewhere, each once."""

    def send_keys(batches):
        for batch in batches:
            found = [p.keys() for _, p in parses(batch.column(0), width, rounds)]
            keys = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            keys, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.minimum(n, 2).astype(np.int32))], ["key", "n"])

    keys = docs.select("text").mapInArrow(send_keys, "key long, n int")
    often = materialize(keys.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"))
    seen = docs.sparkSession.sparkContext.broadcast(bloom_of(often, "key", bloom_bits(often.count())))

    def send_windows(batches):
        """(w1, w2, n, id, ats): a window that stands once in a batch with its place; of one that stands there more often, the fact
        alone (n = 2, no place), and its places, which need no other batch, in one row a document under a key of its own (n = 2)."""
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            held = []
            for i, p in parses(batch.column(1), width, rounds):
                which = p.candidates(lambda x: bloom_has(seen.value, x))
                if len(which):
                    text, start = p.places(which)
                    held.append((p.windows(which), p.windows(which, _BASE2) >> _U(33), ids[i + text], start))
            if not held:
                continue
            w1, w2, row, at = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((w2, w1))
            w1, w2, row, at = w1[order], w2[order], row[order], at[order]
            new = np.ones(len(w1), bool)
            new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
            first = np.flatnonzero(new)
            many = np.diff(np.append(first, len(w1)))
            one, more = first[many == 1], first[many > 1]
            known = np.repeat(many > 1, many)
            kr, ka = row[known], at[known]
            by_doc = np.lexsort((ka, kr))
            kr, ka = kr[by_doc], ka[by_doc]
            begin = np.flatnonzero(np.diff(kr, prepend=kr[0] - 1 if len(kr) else 0)) if len(kr) else np.empty(0, np.int64)
            own = kr[begin]
            lists = np.concatenate([np.arange(len(one)), np.full(len(more), len(one)), len(one) + begin, [len(one) + len(ka)]]).astype(np.int32)
            columns = [
                pa.array(np.concatenate([w1[one], w1[more], mix(own.view(np.uint64))]).view(np.int64)),
                pa.array(np.concatenate([w2[one].astype(np.int32), w2[more].astype(np.int32), np.full(len(own), -1, np.int32)])),
                pa.array(np.concatenate([np.full(len(one), 1, np.int32), np.full(len(more) + len(own), 2, np.int32)])),
                pa.array(np.concatenate([row[one], np.zeros(len(more), np.int64), own])),
                pa.ListArray.from_arrays(pa.array(lists), pa.array(np.concatenate([at[one], ka]).astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["w1", "w2", "n", "id", "ats"])

    sent = docs.select("id", "text").mapInArrow(send_windows, "w1 long, w2 int, n int, id long, ats array<int>")
    total = sent.withColumn("stands", F.sum("n").over(W.partitionBy("w1", "w2")))
    found = total.where("stands > 1 and size(ats) > 0").select("id", "ats")
    # Equal rows have equal places; each is kept once, already before the shuffle.
    return found.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("ats"))).alias("ats"))


def covered(starts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Whether each of n words lies in a window from starts."""
    edge = np.zeros(n + 1, np.int64)
    starts = np.unique(starts)
    edge[starts] += 1
    edge[starts + width] -= 1
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS, digest: bool = False) -> DataFrame:
    """docs, all columns, with text as what is kept (words joined by one space; untouched texts stay as they are), n_words and n_removed.

    digest: in place of the text, kept_sha256 of the kept words, joined. Places come back to a document by a
    hash of its doc_id and text, so rows without an id, or of one id, each get their own.
    """
    small_batches(docs.sparkSession)
    at, of = fresh(docs, "row_hash"), fresh(docs, "places")
    keyed = docs.withColumn(at, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    found = repeated_windows(keyed.select(F.col(at).alias("id"), "text"), width, rounds)
    joined = keyed.join(found.withColumnsRenamed({"id": at, "ats": of}), at, "left").drop(at)
    more = {"n_words": "long", "n_removed": "long"} | ({"kept_sha256": "string"} if digest else {})
    own = [f for f in docs.schema if f.name not in more and not (digest and f.name == "text")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own] + [f"{k} {v}" for k, v in more.items()])

    def run(batches):
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
            texts, places = column("text"), column(of)
            n_words, n_removed, kept = [], [], []
            for text, starts in zip(texts, places, strict=True):
                raw = (text.as_py() or "").encode()
                words, gone = _WORD.findall(raw), 0
                if starts.is_valid:
                    out = covered(starts.values.to_numpy(zero_copy_only=False), len(words), width)
                    gone = int(out.sum())
                    words = [w for w, y in zip(words, out.tolist(), strict=True) if not y] if gone else words
                n_words.append(len(words) + gone)
                n_removed.append(gone)
                joined_words = b" ".join(words) if digest or gone else b""
                kept.append(hashlib.sha256(joined_words).hexdigest() if digest else joined_words.decode() if gone else text.as_py())
            columns = {f.name: column(f.name) for f in own} | {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
            columns["kept_sha256" if digest else "text"] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return joined.mapInArrow(run, schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
