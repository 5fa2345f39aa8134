"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts each text into chunks of about 1 KB, at the same places wherever the same passage
stands. Chunk hashes are counted over the whole corpus, and every chunk that stands twice or more is
reused: those that save most are encoded once, on an executor, and travel to all tasks as a dictionary
of a bounded size; a Bloom filter over the hashes of all shared chunks tells a task which others to keep
when it meets them first, so they are encoded once a task while it holds them (HELD of them). Every text is
then put together from reused chunks, newly encoded ones and the joins between them.

Exactness. A place where white space follows a character that is not white space is a border between
pre-tokens, whatever stands around it. So of a chunk only what lies between its first and its
last such place is reused, and what lies between two chunks' reused parts is the join: it is encoded
anew from a border in the left chunk, over as many chunks as it takes, up to the first border in the
right one. Then the two pieces on either side of each seam are encoded together: they must give what
they give alone. Where a seam doesn't agree, the encoding is repeated over the whole text, which has no
seam. What isn't reused is split at all such borders and each distinct piece of a block of text is
encoded once.

Null text: as an empty one, no tokens. Very long texts: whole, in memory one at a time. Repeated rows
are each encoded. Extra columns pass through encode_documents. Empty table: no rows. A text that holds
a special token's own string gets that token, as the library does by default.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.common import _BASE, _BYTE, _SPACE, Block, blocks, bloom_bits, bloom_has, bloom_of, materialize, mix, powers, small_batches, table

#: Cuts where the low bits of the hash of 16 bytes are 0; sizes in bytes.
WINDOW, MASK, LEAST, MOST = 16, (1 << 10) - 1, 256, 8192
#: The dictionary of shared chunks: its most bytes of text, and its most entries.
DICT_BYTES, DICT_ENTRIES = 8 << 20, 16384
#: Further shared chunks that a task holds at a time.
HELD = 4096
_GEAR = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Bytes of pieces that go to the library itself: control characters and what lies beyond Latin letters.
_RARE = np.zeros(256, bool)
_RARE[0x1C:0x20] = _RARE[0xC2] = _RARE[0xC9:] = True
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(2)
def vocabulary(path: str):
    """(library tokenizer, encoder of ordinary text, bytes of each id, special strings)."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    by_char = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(kept))}
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {bytes(by_char[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    bytes_of = [b""] * (max([*ranks.values(), *special.values()]) + 1)
    for k, v in ranks.items():
        bytes_of[v] = k
    for k, v in special.items():
        bytes_of[v] = k.encode()
    plain = tiktoken.Encoding("kinweave", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(path), plain, bytes_of, [k.encode() for k in special]


# ---- chunks ---------------------------------------------------------------------------------------


def chunk_ends(block: Block) -> list[list[int]]:
    """Of each text of the block, the ends of its chunks as places in the block."""
    data = block.raw
    h = _GEAR[data].astype(np.uint32)
    for shift in (1, 2, 4, 8):
        if len(h) > shift:
            h[shift:] = h[shift:] + (h[:-shift].copy() << np.uint32(shift))
    if len(data):
        starts = (data & 0xC0) != 0x80
        cut = ((h >> np.uint32(16)) & np.uint32(MASK)) == 0
        cut[:-1] &= starts[1:]
    found = np.flatnonzero(cut) + 1 if len(data) else np.empty(0, np.int64)
    out, k, n = [], 0, len(found)
    found = found.tolist()
    at = block.at.tolist()
    for i in range(len(at) - 1):
        a, end, ends = at[i], at[i + 1], []
        while k < n and found[k] <= a:
            k += 1
        while True:
            while k < n and found[k] < a + LEAST:
                k += 1
            b = found[k] if k < n else end
            if b > a + MOST:
                b = a + MOST
                while b > a and b < end and (data[b] & 0xC0) == 0x80:
                    b -= 1
            if b >= end:
                break
            ends.append(b)
            a = b
        if end > at[i]:
            ends.append(end)
        out.append(ends)
    return out


def borders(block: Block) -> np.ndarray:
    """Sorted places in the block where an encoding must have a border: the texts' starts and ends, and white space after something else."""
    data, at = block.raw, block.at
    space = _SPACE[data]
    before = space.copy()
    if len(data) and (data >= 0xC2).any():
        for m in _WIDE_SPACE.finditer(data.tobytes()):
            before[m.end() - 1] = True
    safe = np.zeros(len(data) + 1, bool)
    safe[1:-1] = space[1:] & ~before[:-1] if len(data) else False
    safe[at] = True
    return np.flatnonzero(safe)


def _chunk_rows(batches) -> Iterator[pa.RecordBatch]:
    """(h, n_bytes, n): the chunks of a batch, each hash once."""
    for batch in batches:
        count: dict[int, list[int]] = {}
        for _, _, block in blocks(batch.column(0)):
            raw = block.raw.tobytes()
            for i, ends in enumerate(chunk_ends(block)):
                a = int(block.at[i])
                for b in ends:
                    if b - a >= LEAST:
                        x = count.setdefault(xxhash.xxh3_64_intdigest(raw[a:b]) - 2**63, [b - a, 0])
                        x[1] += 1
                    a = b
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.int64()), pa.array([x[0] for x in count.values()], pa.int64()), pa.array([x[1] for x in count.values()], pa.int64())], ["h", "n_bytes", "n"])


def shared_chunks(docs: DataFrame) -> DataFrame:
    """(h, n_bytes, n): the chunks that stand twice or more."""
    rows = docs.select("text").mapInArrow(_chunk_rows, "h long, n_bytes long, n long")
    return rows.groupBy("h").agg(F.first("n_bytes").alias("n_bytes"), F.sum("n").alias("n")).where("n > 1")


def most_saving(often: DataFrame) -> list[int]:
    """Hashes of the shared chunks that save most, as many as the dictionary's bounds allow."""
    top = often.orderBy(((F.col("n") - 1) * F.col("n_bytes")).desc(), "h").limit(DICT_ENTRIES).collect()
    out, room = [], DICT_BYTES
    for r in top:
        room -= r["n_bytes"]
        if room < 0:
            break
        out.append(r["h"])
    return out


def encode_chunk(path: str, chunk: bytes) -> tuple[int, int, list[int]]:
    """(first border, last border, ids between them)."""
    data = np.frombuffer(chunk, np.uint8)
    at = borders(Block(data, np.array([0, len(data)])))[1:-1]
    first, last = (int(at[0]), int(at[-1])) if len(at) > 1 else (0, 0)
    return first, last, plain_ids(path, chunk[first:last]) if last > first else []


class Reuse:
    """The shared chunks as a task sees them: the dictionary, and those that it has met itself."""

    def __init__(self, path: str, dictionary: dict[int, tuple], shared: np.ndarray):
        self.path, self.dictionary, self.shared = path, dictionary, shared
        self.held: dict[int, tuple] = {}

    def __getstate__(self):
        return self.path, self.dictionary, self.shared

    def __setstate__(self, state):
        self.__init__(*state)

    def find(self, hashes: list[int], chunks: list[bytes]) -> list[tuple | None]:
        """Of each chunk (first border, last border, ids), or None if it isn't shared or has nothing between borders."""
        if not hashes:
            return []
        known = bloom_has(self.shared, np.array(hashes, np.int64).view(np.uint64)).tolist()
        out = []
        for h, chunk, ok in zip(hashes, chunks, known, strict=True):
            got = self.dictionary.get(h) or self.held.get(h) if ok else None
            if ok and got is None:
                got = encode_chunk(self.path, chunk)
                if len(self.held) >= HELD:
                    del self.held[next(iter(self.held))]
                self.held[h] = got
            out.append(got if got and got[2] else None)
        return out


def build_reuse(docs: DataFrame, path: str) -> Reuse:
    """The dictionary's chunks are each encoded once, on an executor."""
    often = materialize(shared_chunks(docs))
    shared = bloom_of(often, "h", bloom_bits(often.count()))
    hashes = most_saving(often)
    if not hashes:
        return Reuse(path, {}, shared)
    wanted = docs.sparkSession.sparkContext.broadcast(frozenset(hashes))

    def texts(batches):
        sent: set[int] = set()
        for batch in batches:
            hs, xs = [], []
            for _, _, block in blocks(batch.column(0)):
                raw = block.raw.tobytes()
                for i, ends in enumerate(chunk_ends(block)):
                    a = int(block.at[i])
                    for b in ends:
                        if b - a >= LEAST:
                            h = xxhash.xxh3_64_intdigest(raw[a:b]) - 2**63
                            if h in wanted.value and h not in sent:
                                sent.add(h)
                                hs.append(h)
                                xs.append(raw[a:b])
                        a = b
            yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(xs, pa.binary())], ["h", "chunk"])

    def encode(batches):
        for batch in batches:
            out = [encode_chunk(path, chunk) for chunk in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.list_(pa.int32()))], ["h", "first", "last", "ids"])

    rows = docs.select("text").mapInArrow(texts, "h long, chunk binary").dropDuplicates(["h"]).mapInArrow(encode, "h long, first int, last int, ids array<int>")
    return Reuse(path, {r["h"]: (r["first"], r["last"], r["ids"]) for r in rows.collect()}, shared)


def plain_ids(path: str, text: bytes) -> list[int]:
    library, plain, _, special = vocabulary(path)
    if not _RARE[np.frombuffer(text, np.uint8)].any() and not any(s in text for s in special):
        return plain.encode_ordinary(text.decode())
    return library.encode(text.decode(), add_special_tokens=False).ids


@functools.lru_cache(1 << 15)
def agrees(path: str, left: bytes, right: bytes) -> bool:
    """Whether two neighbouring pieces give together what they give alone."""
    return plain_ids(path, left + right) == plain_ids(path, left) + plain_ids(path, right)


# ---- whole texts ------------------------------------------------------------------------------------


class Pieces:
    """The ids of pieces between neighbouring borders of a block; each distinct piece is encoded once."""

    def __init__(self, path: str, block: Block, at: np.ndarray, wanted: np.ndarray):
        """at: borders; wanted: whether the piece after each border but the last is asked for."""
        _, plain, self.bytes_of, _ = vocabulary(path)
        raw = block.raw.tobytes()
        starts, ends = at[:-1][wanted], at[1:][wanted]
        total = np.zeros(len(raw) + 1, np.uint64)
        up, down = powers(_BASE, len(raw) + 1)
        np.cumsum(_BYTE[block.raw] * up[: len(raw)], out=total[1:])
        h = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        _, first, self.which = np.unique(h, return_index=True, return_inverse=True)
        a, b = starts[first], ends[first]
        rare = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(_RARE[block.raw], out=rare[1:])
        # Pieces that begin with white space and end otherwise keep their borders side by side: one call encodes them all.
        easy = (rare[b] == rare[a]) & _SPACE[block.raw[a]] & ~_SPACE[block.raw[b - 1]]
        self.ids: list[list[int]] = [[]] * len(first)
        many = np.flatnonzero(easy)
        if len(many):
            together = b"".join([raw[x:y] for x, y in zip(a[many].tolist(), b[many].tolist(), strict=True)])
            ids = plain.encode_ordinary(together.decode())
            sizes = _sizes(path)[np.array(ids, np.int64)]
            ends_at = np.searchsorted(np.cumsum(sizes), np.cumsum(b[many] - a[many])) + 1
            k = 0
            for i, end in zip(many.tolist(), ends_at.tolist(), strict=True):
                self.ids[i] = ids[k:end]
                k = end
        for i in np.flatnonzero(~easy).tolist():
            self.ids[i] = plain_ids(path, raw[a[i] : b[i]])


@functools.lru_cache(2)
def _sizes(path: str) -> np.ndarray:
    return np.array([len(x) for x in vocabulary(path)[2]], np.int64)


def encode_block(path: str, block: Block, reuse: Reuse | None) -> Iterator[tuple]:
    """For each text of the block (parts, names): lists of ids that follow each other, and names that say which parts are equal, so that what is made of a part can be kept."""
    at = borders(block)
    raw = block.raw.tobytes()
    n_pieces = len(at) - 1
    wanted = np.ones(max(0, n_pieces), bool)
    reused: list[list[tuple]] = [[] for _ in range(len(block.at) - 1)]  # of each text: (first piece, piece after the last, chunk, ids)
    if reuse is not None:
        met = []
        for i, ends in enumerate(chunk_ends(block)):
            a = int(block.at[i])
            for b in ends:
                if b - a >= LEAST:
                    met.append((i, a, xxhash.xxh3_64_intdigest(raw[a:b]) - 2**63, b))
                a = b
        for (i, a, h, _), got in zip(met, reuse.find([x[2] for x in met], [raw[x[1] : x[3]] for x in met]), strict=True):
            if got:
                x, y = int(np.searchsorted(at, a + got[0])), int(np.searchsorted(at, a + got[1]))
                reused[i].append((x, y, h, got[2]))
    special = vocabulary(path)[3]
    text_at = np.searchsorted(at, block.at).tolist()
    place = at.tolist()
    whole = []
    for i, mine in enumerate(reused):
        a, b = int(block.at[i]), int(block.at[i + 1])
        piece = lambda k: raw[place[k] : place[k + 1]]  # noqa: E731, B023
        seams = {k for x, y, _, _ in mine for k in (x, y) if text_at[i] < k < text_at[i + 1]}
        whole.append(any(s in raw[a:b] for s in special) or not all(agrees(path, piece(k - 1), piece(k)) for k in seams))
        for x, y, _, _ in () if whole[i] else mine:
            wanted[x:y] = False
    held = Pieces(path, block, at, wanted) if wanted.any() else None
    nth = np.cumsum(wanted) - wanted  # among the wanted ones
    which = held.which.tolist() if held else []
    for i, mine in enumerate(reused):
        if whole[i]:
            yield [plain_ids(path, raw[int(block.at[i]) : int(block.at[i + 1])])], [None]
            continue
        parts, names, p = [], [], text_at[i]
        for x, y, h, ids in [*mine, (text_at[i + 1], text_at[i + 1], None, None)]:
            if x > p:
                between = which[int(nth[p]) : int(nth[p]) + x - p]
                parts += [held.ids[k] for k in between]
                names += between
            if h is not None:
                parts.append(ids)
                names.append(("chunk", h))
            p = y
        yield parts, names


def encoder(path: str, reuse, digest: bool):
    """A function for mapInArrow: the batch's other columns, then ids and n_tokens, or the digests."""

    def run(batches):
        shared = reuse.value if reuse is not None else None
        bytes_of = vocabulary(path)[2]
        text_of = [str(i) for i in range(len(bytes_of))]
        made: dict = {}  # of reused chunks
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            n_tokens, ids, ids_sha, decoded_sha = [], [], [], []
            for _, _, block in blocks(texts, most=1 << 21):
                kept: dict = {}
                if len(made) > 4 * HELD:
                    made.clear()
                for parts, names in encode_block(path, block, shared):
                    n_tokens.append(sum(map(len, parts)))
                    if not digest:
                        ids.append([x for part in parts for x in part])
                        continue
                    strings, raws = [], []
                    for part, name in zip(parts, names, strict=True):
                        memo = made if isinstance(name, tuple) else kept
                        got = memo.get(name) if name is not None else None
                        if got is None:
                            got = ",".join([text_of[x] for x in part]), b"".join([bytes_of[x] for x in part])
                            if name is not None:
                                memo[name] = got
                        strings.append(got[0])
                        raws.append(got[1])
                    ids_sha.append(hashlib.sha256(",".join(strings).encode()).hexdigest())
                    whole = b"".join(raws)
                    decoded_sha.append(hashlib.sha256(whole.decode("utf-8", "replace").encode()).hexdigest())
            others = {k: batch.column(i) for i, k in enumerate(batch.schema.names) if k != "text" or not digest}
            extra = {"n_tokens": pa.array(n_tokens, pa.int64())}
            extra |= {"ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(decoded_sha, pa.string())} if digest else {"ids": pa.array(ids, pa.list_(pa.int32()))}
            others = {k: v for k, v in others.items() if k not in extra} | extra
            yield pa.RecordBatch.from_arrays(list(others.values()), list(others))

    return run


def _schema(df: DataFrame, drop: tuple[str, ...], more: str) -> str:
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in drop]
    return ", ".join([*own, more])


def _shared(docs: DataFrame, path: str, reuse: bool):
    return docs.sparkSession.sparkContext.broadcast(build_reuse(docs, path)) if reuse else None


def encode_documents(docs: DataFrame, path: str | None = None, reuse: bool = True) -> DataFrame:
    """docs, all columns, with ids (array<int>) and n_tokens; own columns of these names are replaced."""
    path = path or default_tokenizer()
    small_batches(docs.sparkSession)
    return docs.mapInArrow(encoder(path, _shared(docs, path, reuse), False), _schema(docs, ("ids", "n_tokens"), "n_tokens long, ids array<int>"))


def decode_documents(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """tokens (a column ids) with their text, special tokens included; null ids: null text."""
    path = path or default_tokenizer()
    small_batches(tokens.sparkSession)

    def run(batches):
        bytes_of = vocabulary(path)[2]
        for batch in batches:
            texts = [None if x is None else b"".join([bytes_of[i] for i in x]).decode("utf-8", "replace") for x in batch.column(batch.schema.get_field_index("ids")).to_pylist()]
            own = {k: batch.column(i) for i, k in enumerate(batch.schema.names) if k != "text"} | {"text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays(list(own.values()), list(own))

    return tokens.mapInArrow(run, _schema(tokens, ("text",), "text string"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), default_tokenizer()
    small_batches(spark)
    return docs.mapInArrow(encoder(path, _shared(docs, path, True), True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
