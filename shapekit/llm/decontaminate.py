"""Benchmark decontamination with suffix arrays over the training documents.

Each task builds suffix arrays over its documents, a bounded run of them (a
shard) at a time, and binary-searches every benchmark suffix in each array.  The
array is sparse: a suffix whose first two words never stand together in the
benchmark (or whose first word is no one-word item) cannot start a match, and is
left out.  Suffixes are sorted to the depth of a window, which is what the search
compares; longer matches are runs of windows on one diagonal.  The equal range
of a window gives all its occurrences in the shard, so one pass over the
documents yields every match and location without a shuffle.

The benchmark is read to the driver in chunks of at most ``CHUNK_BYTES`` of text, chosen by
hash, and each chunk is sent to the tasks.  A larger benchmark takes more passes,
whose hits are merged per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

WINDOW = 10
CHUNK_BYTES = 8 << 20
FILTER_BITS = 22

_U = np.uint64


def _pair(h: np.ndarray) -> np.ndarray:
    """Hash of each word with the next (the last one with 0)."""
    nxt = np.zeros_like(h)
    nxt[:-1] = h[1:]
    return C.mix(h * _U(3) + nxt)


class Suffixes:
    """Windows of benchmark items as rows of word hashes, with their lengths and items."""

    def __init__(self, ids: list, texts: list, window: int = WINDOW):
        self.window = window
        rows, length, item, place = [], [], [], []
        pairs, singles = [], []
        col = pa.array(texts, pa.string())
        for i, j, data, off in C.text_steps(col):
            words = C.Words(C.LOWER[data], off, C.NON_ALNUM)
            h = words.hashes()
            for k in range(j - i):
                a, b = words.off[k], words.off[k + 1]
                w = min(window, b - a)
                if not w:
                    continue
                starts = np.arange(a, b - w + 1)
                m = np.zeros((len(starts), window), np.uint64)
                m[:, :w] = h[starts[:, None] + np.arange(w)]
                rows.append(m)
                length.append(np.full(len(starts), w))
                item.append(np.full(len(starts), i + k))
                place.append(starts - a)
                (pairs if w > 1 else singles).append(m[:, :2])
        self.ids = ids
        self.rows = np.concatenate(rows) if rows else np.zeros((0, window), np.uint64)
        self.length = np.concatenate(length) if rows else np.zeros(0, np.int64)
        self.item = np.concatenate(item) if rows else np.zeros(0, np.int64)
        self.place = np.concatenate(place) if rows else np.zeros(0, np.int64)
        mask = _U((1 << FILTER_BITS) - 1)
        self.first = np.zeros(1 << FILTER_BITS, bool)
        self.two = np.zeros(1 << FILTER_BITS, bool)
        if singles:
            self.first[np.concatenate(singles)[:, 0] & mask] = True
        if pairs:
            p = np.concatenate(pairs)
            self.two[C.mix(p[:, 0] * _U(3) + p[:, 1]) & mask] = True
        self.mask = mask


def suffix_array(h: np.ndarray, end: np.ndarray, bench: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Sparse suffix array of word hashes: ``(starts in suffix order, their first words)``.

    ``end`` is the end of each word's document; words beyond it read as 0."""
    keep = bench.two[_pair(h) & bench.mask]
    if bench.first.any():
        keep |= bench.first[h & bench.mask]
    at = np.flatnonzero(keep)
    rows = np.zeros((len(at), bench.window), np.uint64)
    for k in range(bench.window):
        inside = at + k < end[at]
        rows[inside, k] = h[at[inside] + k]
    order = np.lexsort(rows.T[::-1])
    return at[order], rows[order]


def _bound(rows: np.ndarray, bench: Suffixes, upper: bool) -> np.ndarray:
    """Binary search of every benchmark window at once (lower or upper bound of its prefix)."""
    n = len(bench.rows)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(rows), np.int64)
    used = np.arange(bench.window)[None, :] < bench.length[:, None]
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        got, want = rows[mid], bench.rows[open_]
        differ = (got != want) & used[open_]
        k = differ.argmax(1)
        some = differ[np.arange(len(open_)), k]
        g, w = got[np.arange(len(open_)), k], want[np.arange(len(open_)), k]
        right = np.where(some, g < w, upper)
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]


def _hits(bench: Suffixes, col: pa.Array):
    """Matches in each step of a text column: ``(first, last, words, covered words,
    hit documents, hit items, longest match of each document)``."""
    for i, j, data, off in C.text_steps(col):
        words = C.Words(C.LOWER[data], off, C.NON_ALNUM)
        h = words.hashes()
        cover = np.zeros(len(h) + 1, np.int64)
        hit_doc = hit_item = np.zeros(0, np.int64)
        longest = np.zeros(j - i, np.int64)
        if len(h) and len(bench.rows):
            at, rows = suffix_array(h, np.repeat(words.off[1:], np.diff(words.off)), bench)
            lo, hi = _bound(rows, bench, False), _bound(rows, bench, True)
            count = hi - lo
            which = np.repeat(np.arange(len(lo)), count)
            start = at[np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + lo[which]]
            if len(start):
                item, size = bench.item[which], bench.length[which]
                np.add.at(cover, start, 1)
                np.add.at(cover, start + size, -1)
                doc = np.searchsorted(words.off, start, "right") - 1
                pair = np.unique(doc * len(bench.ids) + item)
                hit_doc, hit_item = pair // len(bench.ids), pair % len(bench.ids)
                # runs of windows on one diagonal of (document, item) are one longer match
                diag = start - bench.place[which]
                o = np.lexsort((start, diag, item, doc))
                run = np.stack((doc, item, diag, start), 1)[o]
                new = np.ones(len(o), bool)
                new[1:] = (run[1:] != run[:-1] + np.array([0, 0, 0, 1])).any(1)
                head = np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))
                np.maximum.at(longest, run[:, 0], run[:, 3] - run[head, 3] + size[o])
        yield i, j, words, np.cumsum(cover)[:-1] > 0, hit_doc, hit_item, longest


def _scan(held):
    def run(batches):
        bench = held.value
        for batch in batches:
            ids, prints = C.column(batch, "doc_id"), C.column(batch, "print")
            for i, j, words, hit, hit_doc, hit_item, longest in _hits(bench, C.column(batch, "text")):
                # covered ranges, cut at document bounds
                bound = np.zeros(len(hit) + 1, bool)
                bound[words.off] = True
                first = np.flatnonzero(hit & (bound[:-1] | ~np.concatenate(([False], hit[:-1]))))
                last = np.flatnonzero(hit & (bound[1:] | ~np.concatenate((hit[1:], [False])))) + 1
                of = np.searchsorted(words.off, first, "right") - 1
                spans = pa.StructArray.from_arrays([pa.array(first - words.off[of], pa.int64()), pa.array(last - words.off[of], pa.int64())], names=["start", "stop"])
                each = np.arange(j - i + 1)
                items = pa.array(bench.ids, pa.int64()).take(pa.array(hit_item, pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(i, j - i), prints.slice(i, j - i), pa.array(np.diff(words.off), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(of, each), pa.int32()), spans),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(hit_doc, each), pa.int32()), items), pa.array(longest),
                ], names=["doc_id", "print", "n_words", "spans", "items", "longest"])
    return run


def _clean(held):
    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for i, _, _, _, hit_doc, _, _ in _hits(held.value, C.column(batch, "text")):
                keep[i + hit_doc] = False
            yield batch.filter(pa.array(keep))
    return run


SCHEMA = "doc_id long, print long, n_words long, spans array<struct<start:long,stop:long>>, items array<long>, longest long"


def _chunks(spark: SparkSession, benchmark: DataFrame, window: int, chunk_bytes: int) -> list:
    """The benchmark's windows as broadcasts of about ``chunk_bytes`` of text each, at least one."""
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // chunk_bytes))
    out = []
    for c in range(n):
        rows = (bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == c) if n > 1 else bench).toArrow()
        out.append(spark.sparkContext.broadcast(Suffixes(rows["item_id"].to_pylist(), rows["text"].to_pylist(), window)))
    return out


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any match, all columns unchanged; one pass per benchmark chunk."""
    C.prepare(spark)
    for held in _chunks(spark, benchmark, window, chunk_bytes):
        docs = docs.mapInArrow(_clean(held), docs.schema)
    return docs


def matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
            chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(doc_id, n_words, n_hit, spans, items, longest)`` for every row of ``docs``.

    ``spans`` are the word ranges covered by any occurrence of a benchmark window, ``items`` the
    ids of the items with an occurring window, ``longest`` the words of the longest verbatim match.

    Null or wordless texts: no words, no hits.  An item of fewer words than a window
    (but some) is one window; null or wordless items match nothing.  An item whose id is null is
    matched but not listed.  Items of equal text are each listed; an item id is listed once.
    Repeated document rows are each returned.  An empty benchmark hits nothing.
    Other columns are ignored.
    """
    C.prepare(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), "text")
    parts = [source.mapInArrow(_scan(held), SCHEMA) for held in _chunks(spark, benchmark, window, chunk_bytes)]
    found, chunks = parts[0], len(parts)
    if chunks > 1:  # rows of one document over the chunks; equal rows are told by their number
        for p in parts[1:]:
            found = found.unionByName(p)
        merged = (found.groupBy("doc_id", "print", "n_words")
                  .agg(F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
                       F.max("longest").alias("longest"), (F.count("*") / chunks).cast("int").alias("rows")))
        joined = F.aggregate(
            F.array_sort("spans"), F.array().cast("array<struct<start:long,stop:long>>"),
            lambda a, s: F.when((F.size(a) > 0) & (F.element_at(a, -1)["stop"] >= s["start"]),
                                F.concat(F.slice(a, 1, F.size(a) - 1),
                                         F.array(F.struct(F.element_at(a, -1)["start"].alias("start"),
                                                          F.greatest(F.element_at(a, -1)["stop"], s["stop"]).alias("stop")))))
            .otherwise(F.concat(a, F.array(s))))
        found = merged.withColumn("spans", joined).withColumn("r", F.explode(F.sequence(F.lit(1), "rows")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    items = F.array_distinct(F.filter("items", lambda x: x.isNotNull()))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", items.alias("items"), "longest")


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Per document: words, words hit, items with their digest, and the verdict."""
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return (matches(spark, docs, benchmark, **kw)
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"), "longest"))
