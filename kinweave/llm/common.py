"""Shared pieces: tables written between jobs, numpy text blocks, bounded sketches, components."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Text bytes that a Python worker turns into numpy arrays at a time.
BLOCK_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MARKED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application that driver and executors share: below spark.checkpoint.dir, or the warehouse where that is unset. It goes when the application ends."""
    above = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{above}/kinweave-{spark.sparkContext.applicationId}"
    if path not in _MARKED:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _MARKED.add(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back, which also cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialize wrote and nothing needs any more, and let Spark delete the shuffles that made them."""
    spark = tables[0].sparkSession
    for df in tables:
        path = df.inputFiles()[0].rsplit("/", 1)[0] if df.inputFiles() else None
        if path and path.rsplit("/", 2)[-2] == shared_dir(spark).rsplit("/", 1)[-1]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    gc.collect()
    spark._jvm.System.gc()  # Spark's cleaner works when plans are collected


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in whatever case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep the Arrow batches small, since a document may be long, and a worker's linear algebra to its own core: a task has one."""
    spark.sparkContext.environment["OPENBLAS_NUM_THREADS"] = "1"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def crc_fold(doc_id):
    return F.crc32(doc_id.cast("string")) % 3


# ---- numpy text blocks ------------------------------------------------------------------------

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 3
_BASE2 = 0xC2B2AE3D27D4EB4F | 3


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.multiply.accumulate(np.full(n - 1, base & (2**64 - 1), np.uint64))
    return out


_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n."""
    have = _CACHE.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        have = _powers(base, size), _powers(pow(base, -1, 2**64), size)
        _CACHE[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def rolling(h: np.ndarray, width: int, base: int = _BASE) -> np.ndarray:
    """Polynomial hash of every run of width values; empty if there are fewer."""
    n = len(h)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = powers(base, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up, out=total[1:])
    return mix((total[width:] - total[: n - width + 1]) * down[: n - width + 1])


class Block:
    """Some texts side by side: bytes, where texts start, and their words' places and hashes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool = False):
        self.raw = data
        self.data = _LOWER[data] if lower else data
        self.at = at  # n + 1 offsets of texts

    def words(self) -> None:
        word = ~_SPACE[self.data]
        n = len(word)
        begins, ends = word.copy(), word.copy()
        if n:
            begins[1:] &= ~word[:-1]
            ends[:-1] &= ~word[1:]
            inner = self.at[(self.at < n)]
            begins[inner] = word[inner]
            last = self.at[self.at > 0] - 1
            ends[last] = word[last]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.at)  # of each text's words; n + 1

    def hash_words(self) -> np.ndarray:
        n = len(self.data)
        up, down = powers(_BASE, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up[:n], out=total[1:])
        length = (self.end - self.start).astype(np.uint64)
        return mix((total[self.end] - total[self.start]) * down[self.start] + length)


def blocks(texts: pa.Array, lower: bool = False, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    """(first row, end row, Block) over a batch's texts, about `most` bytes each; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()) if texts.null_count == 0 else texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if n and texts.buffers()[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        j = min(j, n)
        yield i, j, Block(data[at[i] : at[j]], at[i : j + 1] - at[i], lower)
        i = j


# ---- sketches of a fixed size, filled on the executors ------------------------------------------

SKETCH_BLOCKS = 64


def fold_blocks(rows: DataFrame, read: Callable, join: Callable) -> DataFrame:
    """Rows (block int, cells binary), a task's own already joined, are joined cell by cell; batches stream, so memory is one sketch a task. read: cells of bytes."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = read(cells)
                held[k] = x.copy() if k not in held else join(held[k], x)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["block", "cells"])

    return rows.repartition(SKETCH_BLOCKS, "block").mapInArrow(run, "block int, cells binary")


def gather_blocks(rows: DataFrame, dtype: str, cells: int) -> np.ndarray:
    """The whole sketch on the driver: its size is fixed, whatever the input."""
    out = np.zeros(cells, dtype)
    width = cells // SKETCH_BLOCKS
    for k, data in rows.collect():
        out[k * width : (k + 1) * width] = np.frombuffer(data, dtype)
    return out


def bloom_cells(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit places of each 64-bit value; bits: a power of two."""
    v = mix(values.astype(np.uint64) + _U(0x632BE59BD9B4E019))
    return v % _U(bits), (v >> _U(32) | v << _U(32)) * _U(0x9E3779B97F4A7C15) >> _U(20) & _U(bits - 1)


#: Least and most bits of a Bloom filter: 1 and 64 MB.
BLOOM_LEAST, BLOOM_MOST = 1 << 23, 1 << 29


def bloom_bits(n: int) -> int:
    """Bits for n values: 16 for each, within the bounds."""
    bits = BLOOM_LEAST
    while bits < 16 * n and bits < BLOOM_MOST:
        bits *= 2
    return bits


def bloom_of(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A Bloom filter over a long column, as bytes; 64 MB at most. A false positive costs work later, never a wrong row: exact joins follow."""
    width = bits // 8 // SKETCH_BLOCKS

    def run(batches):
        packed = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False)
            for x in bloom_cells(v, bits):
                np.bitwise_or.at(packed, (x >> _U(3)).astype(np.int64), np.left_shift(1, (x & _U(7)).astype(np.uint8), dtype=np.uint8))
        for k in range(SKETCH_BLOCKS):
            part = packed[k * width : (k + 1) * width]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "cells"])

    rows = df.select(F.col(column).cast("long").alias("v")).where("v is not null").mapInArrow(run, "block int, cells binary")
    return gather_blocks(fold_blocks(rows, lambda x: np.frombuffer(x, np.uint8), np.bitwise_or), "u1", bits // 8)


def bloom_has(cells: np.ndarray, values: np.ndarray) -> np.ndarray:
    found = np.ones(len(values), bool)
    for x in bloom_cells(values, len(cells) * 8):
        x = x.astype(np.int64)
        found &= (cells[x >> 3] >> (x & 7).astype(np.uint8)) & 1 == 1
    return found


# ---- connected components -----------------------------------------------------------------------


#: Labels meet their nodes in so many parts, so that a component of a third of all nodes isn't one key.
LABEL_SALTS = 8


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node reachable over edges (a, b).

    Rounds of taking the neighbours' least label, then the label's label, until nothing changes. A node with
    many neighbours is split by Spark's skewed joins and aggregated in part first; labels are dealt to
    LABEL_SALTS parts of their nodes.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = materialize(labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")))
        used = step.select("label").distinct()
        up = used.join(step.select(F.col("node").alias("label"), F.col("label").alias("top")), "label")
        up = up.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
        dealt = step.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(LABEL_SALTS)).cast("int"))
        labels = materialize(dealt.join(up, ["label", "salt"], "left").select("node", "was", F.coalesce("top", "label").alias("label")))
        if labels.where("label <> was").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
