"""Target-distribution importance resampling on hashed n-grams.

A text becomes one string in which every run of separators is a single blank.  A ``regex``
pattern of a fixed number of words, bounded by lookarounds and run with ``overlapped=True``, then finds
each n-gram's span by itself, overlapping ones included; its bytes go straight into a CRC-32, whose
remainder is the n-gram's bucket.  Nothing is split into word lists.

Texts are scanned once.  The bucket numbers of each document, two or four bytes a feature, are
written to the shared folder; totals per bucket and document weights come from that table.  A task
keeps one counter per bucket, so what is shuffled and held is a multiple of the number of
buckets (a parameter), whatever the corpus holds.

The draw takes the highest of weight + Gumbel noise (a hash of the id), which is sampling without
replacement in proportion to the weights.  Scores are whole numbers of a range bounded by
arithmetic (logarithms of 64-bit counts in thousandths), so ranks come from a count per score and
a window inside each score; there is no global sort.
"""

from __future__ import annotations

from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

BUCKETS = 10_000
GRAMS = (1, 1)
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024

#: A-Z to a-z, ASCII outside of letters and digits to blanks
FOLD = bytes(32 if C.NON_ALNUM[b] else int(C.LOWER[b]) for b in range(256))
RUNS = regex.compile(rb" {2,}")


def patterns(grams: tuple[int, int]) -> list[regex.Pattern]:
    """One pattern per length: that many words with single blanks between, bounded on both sides."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1)) for n in range(grams[0], grams[1] + 1)]


def collapsed(raw: bytes) -> bytes:
    """The folded text with single blanks between its words."""
    return RUNS.sub(b" ", raw.translate(FOLD)).strip(b" ")


def bucket_ids(text: bytes, grams: list[regex.Pattern], buckets: int) -> np.ndarray:
    """Buckets of all n-grams of a collapsed text, in the order of length, then place."""
    first = itemgetter(0)
    found = [np.fromiter(map(crc32, map(first, p.finditer(text, overlapped=True))), np.uint32) for p in grams]
    return (found[0] if len(found) == 1 else np.concatenate(found)) % np.uint32(buckets)


def _width(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def _scan(grams: tuple[int, int], buckets: int):
    def run(batches):
        pats, kind = patterns(grams), _width(buckets)
        for batch in batches:
            texts = C.column(batch, "text").cast(pa.large_binary())
            ids, ends, held, words, at = C.column(batch, "doc_id"), [0], [], [], 0
            for k in range(len(texts)):
                text = collapsed(texts[k].as_py() or b"")
                words.append(text.count(b" ") + 1 if text else 0)
                held.append(bucket_ids(text, pats, buckets).astype(kind).tobytes())
                ends.append(ends[-1] + len(held[-1]))
                if ends[-1] >= C.STEP_BYTES * 8 or k == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(at, len(words)), pa.array(words, pa.int64()), pa.array(held, pa.binary())],
                        names=["doc_id", "n_words", "features"])
                    ends, held, words, at = [0], [], [], k + 1
    return run


def features(docs: DataFrame, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, n_words, features)``: the buckets of all n-grams of each text, as unsigned numbers of
    two bytes (four above 65,536 buckets)."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_scan(grams, buckets), "doc_id long, n_words long, features binary"))


def _numbers(col: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All feature numbers of a batch and the offsets of its rows."""
    col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    raw = col.buffers()[2]
    size = np.dtype(kind).itemsize
    if raw is None or off[-1] == off[0]:
        return np.zeros(0, kind), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(raw, np.uint8)[off[0]:off[-1]].view(kind), (off - off[0]) // size


def _totals(buckets: int):
    def run(batches):
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            numbers, _ = _numbers(C.column(batch, "features"), _width(buckets))
            seen += np.bincount(numbers, minlength=buckets)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(seen[some])], names=["bucket", "n"])
    return run


def bucket_totals(found: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences per bucket; a task sends one row per bucket, the driver receives one row per bucket."""
    rows = (found.select("features").mapInArrow(_totals(buckets), "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed target and source shares, per bucket."""
    b, s, t = len(source), source.sum(), target.sum()
    ratio = (target + 1.0) * float(s + b) / ((source + 1.0) * float(t + b))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(held, buckets: int):
    def run(batches):
        gain = held.value
        for batch in batches:
            numbers, off = _numbers(C.column(batch, "features"), _width(buckets))
            n = np.diff(off)
            total = np.concatenate(([0], np.cumsum(gain[numbers])))
            weight = (total[off[1:]] - total[off[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([
                C.column(batch, "doc_id"), C.column(batch, "n_words"), pa.array(n.astype(np.int64)), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(seed: int):
    """Gumbel noise of a document in thousandths, from the first 32 bits of a hash of seed and id."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, grams: tuple[int, int] = GRAMS, buckets: int = BUCKETS,
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs(doc_id, text)``: the draw of
    ``percent`` in a hundred of the documents with ``least_words`` words, ``rank`` 1 for the highest
    score and null for those not drawn.  ``target(text)`` gives the wanted distribution.

    Null, empty or wordless texts: no features, weight 0, never drawn.  A null doc_id hashes as an empty
    id and comes last among ties.  Rows that repeat a doc_id are documents of their own; among equal
    scores the one with fewer features comes first.  An empty target leaves the smoothing only.  Empty
    ``docs``: empty result.  Other columns are ignored.
    """
    C.prepare(spark)
    found = C.store(spark, features(docs, grams, buckets), "resample-features")
    wanted = features(target.select(F.lit(0).alias("doc_id"), "text"), grams, buckets)
    gain = gains(bucket_totals(found, buckets), bucket_totals(wanted, buckets))
    held = spark.sparkContext.broadcast(gain)
    weighed = found.mapInArrow(_weigh(held, buckets), "doc_id long, n_words long, n_features long, weight long")
    scored = C.store(spark, weighed.withColumn("score", F.col("weight") + noise(seed)), "resample-scores")

    # documents per score: at most some hundred thousand rows, since scores are bounded whole numbers
    able = F.col("n_words") >= least_words
    counts = sorted(scored.where(able).groupBy("score").count().collect(), key=itemgetter(0), reverse=True)
    asked = sum(r[1] for r in counts) * percent // 100
    starts, before = [], 0
    for score, n in counts:
        if before >= asked:
            break
        starts.append((score, before))
        before += n
    cut = starts[-1][0] if starts else None
    high = able & (F.col("score") >= cut) if starts else F.lit(False)
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight"))
    starts_df = spark.createDataFrame(starts, "score long, before long")
    top = (scored.where(high).withColumn("place", place).join(F.broadcast(starts_df), "score")
           .withColumn("rank", (F.col("before") + F.col("place")).cast("long"))
           .withColumn("rank", F.when(F.col("rank") <= asked, F.col("rank"))))
    rest = scored.where(~high).withColumn("rank", F.lit(None).cast("long"))
    cols = ["doc_id", "n_features", "weight", "score", "rank"]
    return top.select(cols).unionByName(rest.select(cols))


def drawn(spark: SparkSession, docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that the draw takes, all columns unchanged (ids that repeat are taken together)."""
    ranks = resample(spark, docs, target, **settings).where("rank is not null").select("doc_id")
    return docs.join(ranks, "doc_id", "left_semi").select([docs[f"`{c}`"] for c in docs.columns])
