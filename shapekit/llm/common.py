"""Helpers shared by the corpus operators: word arrays over Arrow batches,
stable hashes, tables written to the shared folder.

Word scanning works on the UTF-8 bytes of many documents at once.  Both word
definitions used by the operators cut at ASCII bytes only, so byte positions
are enough and no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapekit.session import apply_runtime_conf, scratch_dir

#: bytes that separate words: blank and 0x09-0x0D
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: bytes outside ASCII letters, digits and non-ASCII text
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:128] = [not chr(b).isalnum() for b in range(128)]
#: A-Z to a-z, all other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: text bytes handled by one numpy step (a longer single document is one step)
STEP_BYTES = 1 << 20
STEP_DOCS = 4096

_U = np.uint64
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 3
_POW: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def prepare(spark: SparkSession) -> None:
    """Session settings every operator here relies on."""
    apply_runtime_conf(spark)
    # Arrow batches of documents stay small whatever the mean text length
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "32m")


def store(spark: SparkSession, df: DataFrame, name: str, sort: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint area and read it back.

    Cuts lineage with files every executor can read, so a lost executor costs
    no recomputation of earlier steps.
    """
    path = scratch_dir(spark, name)
    out = df.sortWithinPartitions(*sort) if sort else df
    out.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix): a bijection, so it adds no collisions."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = max(n, STEP_BYTES + (STEP_BYTES >> 2))
        with np.errstate(over="ignore"):
            inv = pow(_BASE, -1, 1 << 64)
            for k, b in ((0, _BASE), (1, inv)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                _POW[k] = np.multiply.accumulate(p)
    return _POW[0], _POW[1]


class Words:
    """Words of a run of documents: ``start``/``end`` byte positions, and
    ``off`` with the index of each document's first word (one more at the end)."""

    __slots__ = ("data", "start", "end", "off")

    def __init__(self, data: np.ndarray, doc_off: np.ndarray, sep: np.ndarray):
        word = ~sep[data]
        n = len(data)
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        cut = doc_off[doc_off < n]
        before[cut] = False
        after = np.zeros(n, bool)
        after[:-1] = word[1:]
        last = doc_off[1:] - 1
        after[last[last >= 0]] = False
        self.data = data
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.off = np.searchsorted(self.start, doc_off)

    def doc(self) -> np.ndarray:
        """Index of the document of each word."""
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes (polynomial over random byte codes,
        one cumulative sum for all words)."""
        return span_hashes(self.data, self.start, self.end)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[:len(data)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix(h ^ ((end - start).astype(np.uint64) << _U(56)))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive word hashes, for every start (documents not yet separated)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    m = 0xD6E8FEB86659FD93
    for k in range(size):
        acc += h[k:k + n] * _U(m)
        m = (m * 0xD6E8FEB86659FD93 + 2) & (2**64 - 1) | 1
    return mix(acc)


def text_steps(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into steps of bounded bytes: ``(first, last, bytes, offsets)``.

    Null texts have no bytes.  The bytes are a view of the Arrow buffer."""
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + STEP_BYTES, "right")) - 1
        j = min(max(j, i + 1), i + STEP_DOCS, n)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def int64(col: pa.Array) -> np.ndarray:
    return col.cast(pa.int64()).to_numpy(zero_copy_only=False)


#: rows looked at for heavy keys, and how often a key must occur among them
HEAVY_SAMPLE = 1_000_000
HEAVY_SEEN = 1000
SALTS = 64


def shared_keys(spark: SparkSession, keyed: DataFrame, array: str, total: float) -> DataFrame:
    """Keys that several documents hold: ``(key, doc_id, first)``, one row per holder.

    ``keyed(doc_id, <array>)`` has each document's distinct keys (long), about ``total`` of them.
    ``first`` is a smaller holder of the key, and equals doc_id for the smallest one only.

    All keys go through one shuffle by key.  Heavy keys are found first, on a sample of documents with about
    ``HEAVY_SAMPLE`` keys: at most ``HEAVY_SAMPLE / HEAVY_SEEN`` of them, whatever the
    table's size.  Their holders are salted over ``SALTS`` groups: ``first`` is the smallest of
    the group, and for that one the smallest of all groups, so no task receives all holders.
    """
    rows = keyed.select("doc_id", F.explode(array).alias("key"))
    part = min(1.0, HEAVY_SAMPLE / max(total, 1))
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(part * (1 << 20))
    heavy = [r[0] for r in keyed.where(pick).select("doc_id", F.explode(array).alias("key")).distinct()
             .groupBy("key").count().where(F.col("count") >= HEAVY_SEEN).select("key").collect()]
    group = Window.partitionBy("key", "salt")
    is_heavy = F.col("key").isin(heavy) if heavy else F.lit(False)
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    found = (rows.select("key", "doc_id", F.when(is_heavy, salt).otherwise(0).alias("salt"))
             .select("key", "doc_id", F.min("doc_id").over(group).alias("first"), F.max("doc_id").over(group).alias("last"))
             .where("first < last"))
    if not heavy:
        return found.select("key", "doc_id", "first")
    least = (rows.where(is_heavy).groupBy("key", salt.alias("salt")).agg(F.min("doc_id").alias("doc_id"))
             .select("key", "doc_id", F.min("doc_id").over(Window.partitionBy("key")).alias("first")))
    return found.where(~is_heavy | (F.col("first") < F.col("doc_id"))).select("key", "doc_id", "first").unionByName(least)
