"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the longest sequence are cut into full sequences and a rest; what is left over is
packed, longest first, into the open bin that it leaves fullest. Where none has room, the permitted
length is opened whose cost for the piece is least: its length plus a fixed cost a sequence, shared by
the pieces of this length that it can hold. In the end each bin is downsized to the shortest permitted
length that holds its contents. Bins are found by their free room in a table of one stack a room, so a
piece costs a look-up in it.

Pieces are dealt by a hash of doc_id into groups of about GROUP pieces, each packed by itself, so a
group's memory is bounded whatever the input; only ids and lengths are sent, never texts.

Null or empty text has no words and gets no piece. Repeated rows are packed each. A null doc_id is packed
like others. Very long texts: whole, in several pieces. Ties: by doc_id, then by piece. Extra columns
are left out. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.common import WORD, materialize, table

LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a sequence besides its places, and pieces packed together.
OVERHEAD, GROUP = 16, 20_000


def opening(size: int, lengths: Sequence[int], overhead: int) -> int:
    """The permitted length of least cost a place used, if filled with pieces of this size; the shorter one of equals."""
    fits = [c for c in lengths if c >= size]
    return min(fits, key=lambda c: ((c + overhead) / (size * (c // size)), c))


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """(bin, offset in it, its final length) of each piece; sizes at most the longest length, in falling order."""
    lengths = sorted(lengths)
    most = lengths[-1]
    by_room: list[list[int]] = [[] for _ in range(most + 1)]
    filled: list[int] = []  # 64 rooms a word, to find the least room that is enough
    words = [0] * (most // 64 + 1)
    room_of: list[int] = []
    bins, offsets = [], []
    for size in sizes:
        w = size >> 6
        found = words[w] >> (size & 63) << (size & 63)
        while not found and w + 1 < len(words):
            w += 1
            found = words[w]
        if found:
            room = (w << 6) + (found & -found).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                words[w] &= ~(1 << (room & 63))
        else:
            b, room = len(room_of), opening(size, lengths, overhead)
            room_of.append(0)
            filled.append(0)
        bins.append(b)
        offsets.append(filled[b])
        filled[b] += size
        left = room - size
        room_of[b] = left
        by_room[left].append(b)
        if left:
            words[left >> 6] |= 1 << (left & 63)
    final = [next(c for c in lengths if c >= n) for n in filled]
    return bins, offsets, [final[b] for b in bins]


def word_count() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))


def pieces(docs: DataFrame, most: int, size: Column | None = None) -> DataFrame:
    """(doc_id, piece, start, length): every place of every document in one piece; size: a document's places, its words if not given."""
    counted = docs.select("doc_id", (word_count() if size is None else size).cast("long").alias("n")).where("n > 0")
    cut = counted.select("doc_id", "n", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / most).cast("int"))).alias("piece"))
    start = F.col("piece") * most
    return cut.select("doc_id", "piece", start.cast("int").alias("start"), F.least(F.lit(most), F.col("n") - start).cast("int").alias("length"))


def pack_documents(docs: DataFrame, lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD, group: int = GROUP, size: Column | None = None) -> DataFrame:
    """(bin, bin_length, offset, doc_id, piece, start, length): where each piece of each document goes.

    start and length are in words, or in the unit of `size`: with F.col("n_tokens") of encode_documents, in tokens.
    """
    cut = materialize(pieces(docs, max(lengths), size))
    groups = max(1, -(-cut.count() // group))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        bins, offsets, final = pack(rows["length"].tolist(), lengths, overhead)
        rows["bin"] = [f"{key[0]}-{b}" for b in bins]
        rows["offset"], rows["bin_length"] = np.array(offsets, np.int32), np.array(final, np.int32)
        return rows[["bin", "bin_length", "offset", "doc_id", "piece", "start", "length"]]

    dealt = cut.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(groups)).cast("int"))
    return dealt.groupBy("g").applyInPandas(lambda key, rows: run(key, rows.drop(columns="g")), "bin string, bin_length int, offset int, doc_id long, piece int, start int, length int")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
