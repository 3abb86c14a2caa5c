"""N-gram Jaccard join with parity sketches.

A document is the set of its distinct 5-word shingles.  A parity sketch flips
one bit per set element, so two sketches differ in at most as many bits as the
sets differ in elements.  The join uses that bound twice:

* **Pigeonhole.**  For Jaccard >= 0.8 with the smaller set of at most ``high``
  elements, the sets differ in at most ``d = high // 4`` elements.  Elements are
  dealt over ``m > d`` bands by hash, and each band keeps a parity sketch (one bit
  position per 32-bit hash, held as its XOR fingerprint).  At least ``m - d`` band
  sketches of a linked pair are equal, so documents that share no band key
  cannot be linked.  A band sketch of zero (nothing in the band) says little, and
  is no key, unless a document has ``m - d`` or more of them.  Only then
  could a pair agree on zero bands alone, and both of its documents have that
  many.  Such documents, rare by the choice of ``m``, emit keys for zero bands too.
* **Hamming filter.**  A dense parity sketch per document, of 1,024 bits or, for larger sets, the
  power of two from the set's size on; a candidate pair whose sketches differ in more than
  ``(|A| + |B|) / 9`` bits is dropped unread.  The longer of two sketches is folded first.

Pairs left are verified on the whole texts with exact set sizes.  The size
bands grow by 1.6, and a document joins its own band and, within 1.25 times that
band's end, the one below.

Components need reachability, not every link.  Documents with equal
sets are one node.  Each key first links its documents to one hub, its smallest, which then is
done with in that key.  Of the others only pairs that share a key but not yet a component are
compared, which completes the links between components exactly; size test and Hamming
filter are part of that join, on sketches of up to ``WIDEST`` words, so that the pairs it makes are close to the
links sought also for long documents that share passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .graph import components

SHINGLE = 5
#: links: 100 * intersection >= NUM * union
NUM = 80
SKETCH_WORDS = 16
#: words of the sketches that travel with keys (4,096 bits: of use for sets of up to about 9,000 shingles)
WIDEST = 64

_U = np.uint64
_LOW52 = _U((1 << 52) - 1)


def size_bands(limit: int) -> list[tuple[int, int]]:
    """(low, high) set sizes, high about 1.6 times low, up to ``limit``."""
    out, low = [], 1
    while low <= limit:
        high = max(low, low * 8 // 5)
        out.append((low, high))
        low = high + 1
    return out


def bands_for(high: int) -> tuple[int, int]:
    """(differing elements allowed, number of pigeonhole bands) of a size band."""
    d = high // 4
    return d, d + 1 + (max(3, -(-d * 3 // 25)) if d else 0)


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (52 bits) of each document of a step: ``(hashes, offsets)``.

    A document with fewer than ``size`` words (but some) has its whole word
    sequence as its one shingle."""
    words = C.Words(C.LOWER[data], off, C.SPACE)
    h = words.hashes()
    n = np.diff(words.off)
    docs = len(n)
    per = np.where(n >= size, n - size + 1, 0)
    doc = np.repeat(np.arange(docs), per)
    first = np.repeat(words.off[:-1] - np.concatenate(([0], np.cumsum(per)[:-1])), per)
    start = first + np.arange(len(doc))
    grams = C.window_hashes(h, size)[start] if len(start) else np.zeros(0, np.uint64)
    for k in range(1, size):  # short documents: one shingle over all k words
        short = np.flatnonzero(n == k)
        if len(short):
            acc = C.window_hashes(h, k)[words.off[short]]
            doc = np.concatenate((doc, short))
            grams = np.concatenate((grams, C.mix(acc + _U(k))))
    key = (doc.astype(np.uint64) << _U(52)) | (grams & _LOW52)
    key.sort()
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    bounds = np.searchsorted(key, np.arange(docs + 1, dtype=np.uint64) << _U(52)) if docs < STEP_LIMIT else None
    return key & _LOW52, bounds


STEP_LIMIT = C.STEP_DOCS  # documents of a step, so that their index fits above 52 bits


def _sets_of(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for i, j, data, off in C.text_steps(col):
        for a in range(i, j, STEP_LIMIT - 1):
            b = min(a + STEP_LIMIT - 1, j)
            lo, hi = off[a - i], off[b - i]
            yield (a, b, *shingle_sets(data[lo:hi], off[a - i:b - i + 1] - lo))


def band_keys(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pigeonhole keys of each set: ``(keys, offsets per document)``, 48 bits each."""
    n = np.diff(off)
    docs = len(n)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(docs + 1, np.int64)
    table = size_bands(int(n.max()) * 2)
    low = np.array([a for a, _ in table])
    high = np.array([b for _, b in table])
    d, m = map(np.array, zip(*(bands_for(int(x)) for x in high), strict=True))
    own = np.searchsorted(low, np.maximum(n, 1), "right") - 1
    element_doc = np.repeat(np.arange(docs), n)
    code = C.mix(h ^ _U(0x5851F42D4C957F2D))
    keys, owner = [], []
    for level, joined in ((own, n > 0), (own - 1, (own > 0) & (n <= high[own - 1] * 5 // 4))):
        level = np.maximum(level, 0)
        joined = joined & (d[level] > 0)  # d = 0 asks for equal sets, which are one node already
        width = np.where(joined, m[level], 0)
        base = np.concatenate(([0], np.cumsum(width)))
        use = joined[element_doc]
        if not use.any():
            continue
        e = element_doc[use]
        cell = base[e] + ((h[use] >> _U(20)) % m[level][e].astype(np.uint64)).astype(np.int64)
        sketch = np.zeros(base[-1], np.uint64)
        np.bitwise_xor.at(sketch, cell, code[use])
        doc = np.repeat(np.arange(docs), width)
        band = np.arange(base[-1]) - base[doc]
        lev = level[doc]
        zero = sketch == 0
        empties = np.bincount(doc[zero], minlength=docs)
        agree = (m - d)[level]
        poor = joined & (empties >= agree)
        keep = ~zero
        if poor.any():  # two poor documents agree on >= m - d zero bands: a prefix of them suffices
            rank = np.cumsum(zero) - zero
            rank = rank - rank[base[doc]]
            keep |= zero & poor[doc] & (rank <= (empties - agree)[doc])
        tag = (lev.astype(np.uint64) << _U(40)) | (band.astype(np.uint64) << _U(1)) | zero.astype(np.uint64)
        k = C.mix(sketch ^ C.mix(tag + _U(1)))[keep] >> _U(16)
        keys.append(k.astype(np.int64))
        owner.append(doc[keep])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(docs + 1, np.int64)
    k, o = np.concatenate(keys), np.concatenate(owner)
    order = np.argsort(o, kind="stable")
    return k[order], np.searchsorted(o[order], np.arange(docs + 1))


def dense_sketch(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches as longs, ``(words, offsets per document)``: a power of two of words, 16 at
    least and a bit per element at least.  Folding halves by XOR gives the sketch of fewer bits."""
    n = np.diff(off)
    words = np.maximum(SKETCH_WORDS, 1 << np.ceil(np.log2(np.maximum(n, 1) / 64)).clip(0).astype(np.int64))
    at = np.concatenate(([0], np.cumsum(words)))
    out = np.zeros(at[-1], np.uint64)
    if len(h):
        doc = np.repeat(np.arange(len(n)), n)
        bit = (h >> _U(7)) & (words[doc].astype(np.uint64) * _U(64) - _U(1))
        np.bitwise_xor.at(out, at[doc] + (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)))
    return out.view(np.int64), at


def _first_of_copies(ids: np.ndarray, null: np.ndarray, fp1: np.ndarray, fp2: np.ndarray, h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of a step without those that equal the set of a smaller doc_id in it and those of
    null ids, which need no keys."""
    n = np.diff(off)
    o = np.lexsort((ids, null, fp2, fp1, n))
    again = np.zeros(len(o), bool)
    again[o[1:]] = (n[o[1:]] == n[o[:-1]]) & (fp1[o[1:]] == fp1[o[:-1]]) & (fp2[o[1:]] == fp2[o[:-1]])
    again |= null
    kept = np.where(again, 0, n)
    return h[np.repeat(~again, n)], np.concatenate(([0], np.cumsum(kept)))


def _profile(batches):
    for batch in batches:
        held = C.column(batch, "doc_id")
        ids, null = C.int64(held.fill_null(-1)), held.is_null().to_numpy(zero_copy_only=False)
        for i, j, h, off in _sets_of(C.column(batch, "text")):
            n = np.diff(off)
            a, b = (np.concatenate((np.zeros(1, np.uint64), np.cumsum(C.mix(h ^ _U(s))))) for s in (0x1234567, 0x7654321ABC))
            a, b = ((x[off[1:]] - x[off[:-1]]).view(np.int64) for x in (a, b))
            sketch, at = dense_sketch(h, off)
            k, koff = band_keys(*_first_of_copies(ids[i:j], null[i:j], a, b, h, off))
            yield pa.RecordBatch.from_arrays([
                held.slice(i, j - i), pa.array(n.astype(np.int64)),
                pa.array(a), pa.array(b),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sketch)),
                pa.ListArray.from_arrays(pa.array(koff, pa.int32()), pa.array(k)),
            ], names=["doc_id", "n", "fp1", "fp2", "sketch", "keys"])


PROFILE = "doc_id long, n long, fp1 long, fp2 long, sketch array<long>, keys array<long>"


def profiles(docs: DataFrame) -> DataFrame:
    """Set size, set fingerprint, dense parity sketch and pigeonhole keys of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_profile, PROFILE)


def _verify(batches):
    for batch in batches:
        a, b = (list(_sets_of(C.column(batch, x))) for x in ("text_a", "text_b"))
        sets = [[], []]
        for out, steps in zip(sets, (a, b), strict=True):
            for _, _, h, off in steps:
                out.extend(h[off[k]:off[k + 1]] for k in range(len(off) - 1))
        ok = []
        for x, y in zip(*sets, strict=True):
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= NUM * (len(x) + len(y) - both))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([C.column(batch, x).filter(keep) for x in ("a", "b")], names=["a", "b"])


def _folded(sketch, words):
    """A sketch folded to fewer words."""
    return F.transform(F.sequence(F.lit(0), words - 1), lambda i: F.aggregate(
        F.sequence(i, F.size(sketch) - 1, words), F.lit(0).cast("long"), lambda a, j: a.bitwiseXOR(sketch[j])))


def _differ(x: str, y: str):
    """Bits in which two sketches differ, at the size of the shorter one."""
    a, b = F.col(x), F.col(y)
    words = F.least(F.size(a), F.size(b))
    level = lambda s: F.when(F.size(s) == words, s).otherwise(_folded(s, words))
    return F.aggregate(F.zip_with(level(a), level(b), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)


def verified(spark: SparkSession, pairs: DataFrame, docs: DataFrame, name: str, grows: bool = False) -> DataFrame:
    """Pairs ``(a, b)`` whose whole texts have a Jaccard similarity of at least 0.8.

    The texts of the pairs' documents are fetched first; only those travel on.  ``grows``: there are
    about as many pairs as copies in the corpus, so a merge join fetches them at every size."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    ids = ids.hint("merge") if grows else ids
    texts = C.store(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                    .join(ids, "doc_id", "left_semi"), "jaccard-texts")
    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return C.store(spark, pairs.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b")
                   .mapInArrow(_verify, "a long, b long"), name)


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id reachable over links (Jaccard of
    distinct 5-word shingles >= 0.8), the document itself included.

    Null or wordless texts: ``n_shingles`` 0, linked with nothing.  Null doc_id: null component, linked with nothing.  Documents of
    one to four words: one shingle.  Repeated rows with one doc_id: each row is returned with the size of
    its own text, all with one component, over which links of either text lead.  Empty input: empty result.  Other columns are ignored.
    """
    C.prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prof = C.store(spark, profiles(docs), "jaccard-profile")
    print_ = F.struct("n", "fp1", "fp2")
    again = (prof.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(print_).alias("one"), F.max(print_).alias("two"))
             .where("one <> two").select("doc_id"))
    if again.isEmpty():
        return _components(spark, docs, prof)

    # ids with several texts: all but one of the texts go by a negative number of their own
    hashed = docs.withColumn("h", F.xxhash64("text"))
    least = hashed.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("h").alias("least"))
    own = F.col("least").isNull() | (F.col("h") == F.col("least"))
    number = F.when(own, F.col("doc_id")).otherwise(-1 - F.shiftrightunsigned(F.xxhash64("doc_id", "h"), 1))
    named = C.store(spark, hashed.join(least, "doc_id", "left").select("doc_id", number.alias("node"), "text"), "jaccard-named")
    inner = named.select(F.col("node").alias("doc_id"), "text")
    found = C.store(spark, _components(spark, inner, C.store(spark, profiles(inner), "jaccard-profile")), "jaccard-found")
    alias = named.where("node <> doc_id").select("doc_id", "node").distinct()
    label = found.select(F.col("doc_id").alias("node"), F.col("component_id").alias("label")).distinct()
    bridges = (alias.join(label, "node").select("doc_id", F.col("label").alias("a"))
               .join(label.select(F.col("node").alias("doc_id"), F.col("label").alias("b")), "doc_id").where("a <> b").select("a", "b"))
    over = components(spark, bridges).select(F.col("node").alias("label"), "component")
    rows = (found.withColumnRenamed("doc_id", "node").join(alias, "node", "left")
            .withColumn("doc_id", F.coalesce("doc_id", "node")).withColumnRenamed("component_id", "label")
            .join(over, "label", "left").withColumn("label", F.coalesce("component", "label")))
    rows = C.store(spark, rows.select("doc_id", "n_shingles", "label"), "jaccard-rows")
    smallest = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return rows.join(smallest, "label", "left").select("doc_id", "n_shingles", "component_id")


def _components(spark: SparkSession, docs: DataFrame, prof: DataFrame) -> DataFrame:
    """``jaccard_components`` where rows of one doc_id have one text."""
    small = prof.select("doc_id", "n", "fp1", "fp2")
    reps = small.where("n > 0 and doc_id is not null").groupBy("n", "fp1", "fp2").agg(F.min("doc_id").alias("rep"))
    reps = C.store(spark, reps, "jaccard-reps")
    rep_ids = reps.select(F.col("rep").alias("doc_id"))
    node = prof.select("doc_id", "n", "sketch").join(rep_ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])

    # keys that several nodes share; copies left in the key rows go out here
    total = (prof.agg(F.sum("n")).first()[0] or 0) / 2
    shared = (C.shared_keys(spark, prof.select("doc_id", "keys"), "keys", total).withColumnRenamed("first", "hub")
              .join(rep_ids, "doc_id", "left_semi").select("key", "doc_id", "hub"))
    shared = C.store(spark, shared, "jaccard-keys")

    def near(pairs: DataFrame) -> DataFrame:
        """Pairs whose dense sketches allow a similarity of 0.8 and whose sizes do."""
        a = node.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        b = node.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        return (pairs.join(a, "a").join(b, "b")
                .where((F.col("na") * 5 >= F.col("nb") * 4) & (F.col("nb") * 5 >= F.col("na") * 4)
                       & (_differ("sa", "sb") * 9 <= F.col("na") + F.col("nb"))).select("a", "b"))

    pairs = shared.where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    tried = C.store(spark, near(pairs), "jaccard-pairs")
    links = verified(spark, tried, docs, "jaccard-links", grows=True)

    # a key's only hub has been compared with all others; those that share no component yet remain (of a
    # salted key, which has several hubs, all do)
    label = components(spark, links)
    named = (shared.join(label.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
             .select("key", "doc_id", "hub", F.coalesce("component", "doc_id").alias("label")))
    other = F.col("doc_id") != F.col("hub")
    rest = F.when(other, F.col("label"))
    one = F.col("first_hub") == F.col("last_hub")
    several = (named.groupBy("key").agg(F.min("hub").alias("first_hub"), F.max("hub").alias("last_hub"), F.min("label").alias("lo"),
                                        F.max("label").alias("hi"), F.min(rest).alias("rest_lo"), F.max(rest).alias("rest_hi"))
               .where(F.when(one, F.col("rest_lo") < F.col("rest_hi")).otherwise(F.col("lo") < F.col("hi"))).select("key", one.alias("one")))
    open_ = C.store(spark, named.join(several, "key").where(other | ~F.col("one")).select("key", "doc_id", "label"), "jaccard-open")
    few = 8  # words that settle most pairs at once, before the whole sketches are looked at
    sketch = _folded(F.col("sketch"), F.least(F.lit(WIDEST), F.size("sketch"))).alias("sketch")
    full = (open_.join(node.select("doc_id", "n", sketch, _folded(F.col("sketch"), F.lit(few)).alias("few")), "doc_id")
            .select("key", "doc_id", "label", "n", "sketch", "few"))
    x, y = full.alias("x"), full.alias("y")
    apart = sum((F.bit_count(F.col("x.few")[k].bitwiseXOR(F.col("y.few")[k])) for k in range(few)), F.lit(0))
    more = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.doc_id") < F.col("y.doc_id"))
                   & (F.col("x.label") != F.col("y.label"))
                   & (F.col("x.n") * 5 >= F.col("y.n") * 4) & (F.col("y.n") * 5 >= F.col("x.n") * 4)
                   & (apart * 9 <= F.col("x.n") + F.col("y.n"))
                   & (_differ("x.sketch", "y.sketch") * 9 <= F.col("x.n") + F.col("y.n")))
            .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct())
    more = C.store(spark, near(more), "jaccard-pairs")
    links = links.unionByName(verified(spark, more, docs, "jaccard-links"))

    label = components(spark, links).select(F.col("node").alias("rep"), "component")
    classes = reps.join(label, "rep", "left").select("n", "fp1", "fp2", F.coalesce("component", "rep").alias("component"))
    return (small.join(classes, ["n", "fp1", "fp2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def without_near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, all columns unchanged.
    Of rows that repeat a doc_id one stays; rows with a null doc_id all stay."""
    groups = C.store(spark, jaccard_components(spark, docs), "jaccard-groups")
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    columns = [f"`{c}`" for c in docs.columns]
    kept = docs.join(gone.hint("merge"), "doc_id", "left_anti").select(columns)
    again = groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    return (kept.join(again, "doc_id", "left_anti").select(columns)
            .unionByName(kept.join(again, "doc_id", "left_semi").select(columns).dropDuplicates(["doc_id"])))
