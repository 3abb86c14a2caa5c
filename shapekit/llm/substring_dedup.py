"""Substring dedup by level-wise doubling of repeated word windows.

A window of ``length`` words (13) that repeats contains shorter windows that repeat.
The levels start at 7 words and double (two windows of 7 that share a word make 13;
for a length of 50 the levels are 7, 14, 28, 50).  At each level a candidate window is
represented by its minimizer: of the level's shorter windows inside it, the one with the
smallest hash.  Equal windows have equal minimizers, so a window whose
minimizer stands in one document only cannot repeat and is dropped; only the rest
are extended to the next length, and the levels end early when no candidate survives.
Minimizers are about a quarter of all positions at the first level, and the
windows of the last level exist only where shorter ones repeat.

Documents whose whole word sequences are equal are one candidate, the smallest doc_id;
the copies lose all words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

LENGTH = 13
FIRST_LEVEL = 7
EMPTY = hashlib.sha256(b"").hexdigest()

_U = np.uint64


def ladder(length: int, first: int = FIRST_LEVEL) -> list[int]:
    """Window lengths of the levels: doubled (or twice less one word) up to ``length``."""
    out = [min(first, length)]
    while out[-1] < length:
        out.append(min(out[-1] * 2, length))
    return out


def _candidates(h: np.ndarray, word_off: np.ndarray, level: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of ``length`` words inside a document: ``(start, document, minimizer)``."""
    n = np.diff(word_off)
    per = np.maximum(n - length + 1, 0)
    doc = np.repeat(np.arange(len(n)), per)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(word_off[:-1], per)
    if not len(start):
        return start, doc, np.zeros(0, np.uint64)
    g = C.window_hashes(h, level)
    low = g[start]
    for k in range(1, length - level + 1):
        np.minimum(low, g[start + k], out=low)
    return start, doc, low


def _key(g: np.ndarray, bits: int) -> np.ndarray:
    return (C.mix(g) >> _U(64 - bits)).astype(np.int64) if bits < 64 else g.view(np.int64)


def _per_doc(doc: np.ndarray, key: np.ndarray, docs: int) -> pa.ListArray:
    """Distinct keys of each document as a list column."""
    o = np.lexsort((key, doc))
    d, k = doc[o], key[o]
    if len(o):
        new = np.ones(len(o), bool)
        new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
        d, k = d[new], k[new]
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(d, np.arange(docs + 1)), pa.int32()), pa.array(k, pa.int64()))


def _prints(words: C.Words, h: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit fingerprints of each document's word sequence."""
    place = (np.arange(len(h)) - words.off[words.doc()]).astype(np.uint64)
    out = []
    for salt in (0x51ED270B, 0x2545F491):
        s = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(C.mix(h ^ C.mix(place + _U(salt))), out=s[1:])
        out.append((s[words.off[1:]] - s[words.off[:-1]]).view(np.int64))
    return out


def _profile(level: int, length: int):
    bits = 64 if level == length else 48  # short keys only propose windows; the last level decides

    def run(batches):
        for batch in batches:
            ids = C.column(batch, "doc_id")
            for i, j, data, off in C.text_steps(C.column(batch, "text")):
                words = C.Words(data, off, C.SPACE)
                h = words.hashes()
                docs = j - i
                prints = _prints(words, h)
                _, doc, low = _candidates(h, words.off, level, length)
                raw = data.tobytes()
                sha = [hashlib.sha256(b" ".join(raw[off[k]:off[k + 1]].split())).hexdigest() for k in range(docs)]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(i, docs), pa.array(np.diff(words.off), pa.int64()), pa.array(prints[0]), pa.array(prints[1]),
                    pa.array(sha, pa.string()), _per_doc(doc, _key(low, bits), docs),
                ], names=["doc_id", "n_words", "fp1", "fp2", "sha", "keys"])
    return run


PROFILE = "doc_id long, n_words long, fp1 long, fp2 long, sha string, keys array<long>"


def _survive(col: pa.Array, held: pa.Array, levels: list[int], at: int, length: int):
    """Steps of a text column with the windows whose minimizer at level ``at`` is held:
    ``(first, last, words, bytes, offsets, starts, documents)``."""
    bits = 64 if levels[at] == length else 48
    hoff = held.offsets.to_numpy()
    values = held.values.to_numpy(zero_copy_only=False)
    for i, j, data, off in C.text_steps(col):
        words = C.Words(data, off, C.SPACE)
        start, doc, low = _candidates(words.hashes(), words.off, levels[at], length)
        key = _key(low, bits)
        mine = values[hoff[i]:hoff[j]].astype(np.int64)
        owner = np.repeat(np.arange(j - i), np.diff(hoff[i:j + 1]))
        # (document, key) membership, both folded to 64 bits
        fold = lambda d, k: C.mix(k.view(np.uint64) ^ C.mix(d.astype(np.uint64) + _U(1)))
        keep = np.isin(fold(doc, key), fold(owner, mine))
        yield i, j, words, data, off, start[keep], doc[keep]


def _extend(levels: list[int], at: int, length: int):
    """Keys of the next level for the windows that survived level ``at``."""
    bits = 64 if levels[at + 1] == length else 48

    def run(batches):
        for batch in batches:
            ids, text = C.column(batch, "doc_id"), C.column(batch, "text")
            for i, j, words, _, _, start, doc in _survive(text, C.column(batch, "held"), levels, at, length):
                h = words.hashes()
                g = C.window_hashes(h, levels[at + 1])
                low = g[start] if len(start) else np.zeros(0, np.uint64)
                for k in range(1, length - levels[at + 1] + 1):
                    np.minimum(low, g[start + k], out=low)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), text.slice(i, j - i), _per_doc(doc, _key(low, bits), j - i)],
                                                 names=["doc_id", "text", "keys"])
    return run


def _remove(levels: list[int], length: int):
    """Remove the words of held windows: what is left of each document."""
    def run(batches):
        for batch in batches:
            ids = C.column(batch, "doc_id")
            for i, j, words, data, _, start, _ in _survive(C.column(batch, "text"), C.column(batch, "held"), levels, len(levels) - 1, length):
                cover = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + length, -1)
                gone = np.cumsum(cover)[:-1] > 0
                total = np.concatenate(([0], np.cumsum(gone)))
                raw = data.tobytes()
                kept = []
                removed = total[words.off[1:]] - total[words.off[:-1]]
                some = np.flatnonzero(removed)
                for k in some:
                    a, b = words.off[k], words.off[k + 1]
                    stay = a + np.flatnonzero(~gone[a:b])
                    kept.append(b" ".join(raw[s:e] for s, e in zip(words.start[stay].tolist(), words.end[stay].tolist(), strict=True)))
                prints = _prints(words, words.hashes())
                yield pa.RecordBatch.from_arrays([
                    ids.slice(i, j - i).take(pa.array(some)), pa.array(prints[0][some]), pa.array(prints[1][some]),
                    pa.array(removed[some], pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ], names=["doc_id", "fp1", "fp2", "removed", "kept"])
    return run


def dedup_windows(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` for every row of ``docs(doc_id, text)``.

    A word goes if a window of ``length`` words that covers it also starts in a document with a
    smaller doc_id.  Windows are judged on the input.  ``kept_sha256`` is over the kept words,
    joined by one space.

    Null or wordless texts: no words, the digest of the empty string.  Texts shorter than a window keep
    all words.  A window that repeats inside one document only stays.  Rows that repeat a doc_id do not count as
    smaller than each other.  Empty input: empty result.  Other columns are ignored.
    """
    C.prepare(spark)
    levels = ladder(length)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prof = C.store(spark, docs.mapInArrow(_profile(levels[0], length), PROFILE), "windows-profile")
    reps = prof.where(F.col("n_words") >= length).groupBy("n_words", "fp1", "fp2").agg(F.min("doc_id").alias("rep"))
    reps = C.store(spark, reps, "windows-reps")
    one = reps.select(F.col("rep").alias("doc_id"), "n_words", "fp1", "fp2")
    keyed = prof.join(one, ["doc_id", "n_words", "fp1", "fp2"], "left_semi").select("doc_id", "keys")
    total = (prof.agg(F.sum("n_words")).first()[0] or 0) / 4
    texts = docs
    for at in range(len(levels)):
        last = at == len(levels) - 1
        rows = C.shared_keys(spark, keyed, "keys", total)
        if last:
            rows = rows.where("first < doc_id")
        held = C.store(spark, rows.groupBy("doc_id").agg(F.collect_set("key").alias("held")), "windows-held")
        if held.isEmpty():
            break
        if not last:
            texts = texts.join(held, "doc_id")
            keyed = texts = C.store(spark, texts.select("doc_id", "text", "held").mapInArrow(
                _extend(levels, at, length), "doc_id long, text string, keys array<long>"), "windows-level")
            texts = texts.select("doc_id", "text")
    same = ["n_words", "fp1", "fp2"]
    out = prof.select("doc_id", "sha", *same).join(reps, same, "left")
    copy = F.col("rep") < F.col("doc_id")
    if held.isEmpty():
        removed, sha = F.lit(0).cast("long"), F.col("sha")
    else:
        left = (texts.join(held, "doc_id").select("doc_id", "text", "held")
                .mapInArrow(_remove(levels, length), "doc_id long, fp1 long, fp2 long, removed long, kept string")
                .select("doc_id", "fp1", "fp2", "removed", F.sha2("kept", 256).alias("left"))
                .dropDuplicates(["doc_id", "fp1", "fp2"]))
        out = out.join(left, ["doc_id", "fp1", "fp2"], "left")
        removed, sha = F.coalesce("removed", F.lit(0)).cast("long"), F.coalesce("left", "sha")
    return out.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(removed).alias("n_removed"),
                      F.when(copy, F.lit(EMPTY)).otherwise(sha).alias("kept_sha256"))
