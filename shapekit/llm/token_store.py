"""Token-id files: per-document zstandard frames under a shared dictionary.

Documents are dealt to parts by doc_id range and sorted, then tokenised and
written.  The store is a folder of two tables that any Spark reader opens:

* ``dictionary``: the zstandard dictionary, its sha256 and the tokenizer's settings;
* ``chunks``: rows in ascending doc_id order, ``(part, seq, first_doc, last_doc, dict_sha256,
  n_tokens, doc_ids, tokens, offsets, payload)``.  ``payload`` is the frames of the chunk's
  documents end to end, ``offsets`` their byte positions.  A document is its ids, little-endian unsigned
  32-bit, compressed by itself, so one short document is read by its chunk's id range,
  one slice and one small decompression.

The dictionary is trained on the serialised id arrays of a bounded sample
(``DICT_DOCS`` documents by hash, at most ``DICT_BYTES``).  Files are committed by Spark's writer,
so a lost executor's part is written anew.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapekit.session import scratch_dir

from . import common as C

END = 2
DICT_DOCS = 1000
DICT_BYTES = 8 << 20
DICT_SIZE = 64 << 10
LEVEL = 3
#: pieces a worker remembers, and pieces encoded as one text
KNOWN_PIECES = 1_200_000
JOINED = 256
CHUNK_BYTES = 4 << 20
PART_BYTES = 16 << 20


# bytes that may follow a blank where text is cut: no white space, and no lead byte of a wide one
_CUT = np.ones(256, bool)
_CUT[list(range(0x21)) + [0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False


class Encoder:
    """Token ids of whole texts, by distinct pieces.

    Byte-level BPE always splits a text before a blank that a non-blank follows, so text is cut
    there.  Each distinct piece (by 64-bit hash) is encoded by the tokenizers library once while it is
    remembered, many pieces as one text: a token that begins with a blank begins the next piece.
    The ids of a text are those of its pieces."""

    _loaded: dict = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.opens[[i for v, i in vocab.items() if v.startswith("\u0120")]] = True  # the blank's sign in byte-level vocabularies
        self.kind = np.uint16 if len(self.opens) <= 1 << 16 else np.uint32
        self._forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _forget(self):
        self.hash = np.zeros(0, np.uint64)  # sorted; start and size go with it
        self.start = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int32)
        self.flat = np.zeros(0, self.kind)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return (np.concatenate([np.array(x, self.kind) for x in ids]) if ids else np.zeros(0, self.kind)), size

    def _learn(self, hashes: np.ndarray, pieces: list[str]):
        """Add pieces that are not known."""
        plain = np.fromiter((p[:1] == " " and p.count(" ") == 1 and len(p) > 1 for p in pieces), bool, len(pieces))
        flats, sizes, orders = [], [], []
        run = np.flatnonzero(plain)
        groups = [run[k:k + JOINED] for k in range(0, len(run), JOINED)]
        if groups:
            flat, size = self._ids(["".join([pieces[k] for k in g]) for g in groups])
            begins = np.flatnonzero(self.opens[flat])
            if len(begins) == len(run) and (np.diff(np.searchsorted(begins, np.concatenate(([0], np.cumsum(size))))) == [len(g) for g in groups]).all():
                flats.append(flat)
                sizes.append(np.diff(np.concatenate((begins, [len(flat)]))))
                orders.append(run)
            else:  # another kind of vocabulary
                plain[:] = False
        rest = np.flatnonzero(~plain)
        flat, size = self._ids([pieces[k] for k in rest])
        flats.append(flat)
        sizes.append(size)
        orders.append(rest)
        size, order = np.concatenate(sizes), np.concatenate(orders)
        start = (len(self.flat) + np.cumsum(size) - size).astype(np.int32)
        self.flat = np.concatenate((self.flat, *flats))
        hashes = hashes[order]
        o = np.argsort(hashes)
        place = np.searchsorted(self.hash, hashes[o])
        self.hash, self.start, self.size = (
            np.insert(old, place, new[o]) for old, new in ((self.hash, hashes), (self.start, start), (self.size, size.astype(np.int32))))

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of the documents of a step, ``END`` after each."""
        if len(self.hash) > KNOWN_PIECES:
            self._forget()
        docs, n = len(off) - 1, len(data)
        begin = np.zeros(n + 1, bool)
        if n:
            begin[:n - 1] = (data[:-1] == 0x20) & _CUT[data[1:]]
        begin[off] = True
        begin[n] = False
        start = np.flatnonzero(begin)
        end = np.concatenate((start[1:], [n])) if len(start) else start
        # a blank that ends a document is followed by no byte of it
        h, first, which = np.unique(C.span_hashes(data, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hash, h)
        at[at == len(self.hash)] = 0
        new = np.flatnonzero(self.hash[at] != h) if len(self.hash) else np.arange(len(h))
        if len(new):
            raw = data.tobytes()
            self._learn(h[new], [raw[a:b].decode() for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
        at = np.searchsorted(self.hash, h)[which]
        size = self.size[at]
        total = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
        ids = self.flat[np.repeat(self.start[at] - total[:-1], size) + np.arange(total[-1])]  # one gather for the step
        last = total[np.searchsorted(start, off[1:])]
        return np.insert(ids, last, END).astype(np.uint32), np.concatenate((np.zeros(1, np.int64), last + np.arange(1, docs + 1)))


def _write(path: str, dictionary: bytes, sha: str):
    def run(batches):
        coder = Encoder.of(path)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        part, seq, docs, tokens, frames, held = None, 0, [], [], [], 0

        def chunk():
            nonlocal seq, docs, tokens, frames, held
            off = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.fromiter(map(len, frames), np.int64, len(frames)))))
            known = [d for d in docs if d is not None]
            row = [part, seq, min(known, default=None), max(known, default=None), sha, sum(tokens), docs, tokens, off.tolist(), b"".join(frames)]
            seq += 1
            docs, tokens, frames, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, TYPES, strict=True)], names=NAMES)

        for batch in batches:
            ids, parts = C.column(batch, "doc_id").to_pylist(), C.column(batch, "part").to_pylist()
            for i, j, data, at in C.text_steps(C.column(batch, "text")):
                flat, off = coder.encode(data, at)
                raw = flat.astype("<u4").tobytes()
                for k in range(j - i):
                    if docs and (parts[i + k] != part or held >= CHUNK_BYTES):
                        yield chunk()
                    if parts[i + k] != part:
                        part, seq = parts[i + k], 0
                    frames.append(pack.compress(raw[4 * off[k]:4 * off[k + 1]]))
                    docs.append(ids[i + k])
                    tokens.append(int(off[k + 1] - off[k]))
                    held += len(frames[-1])
        if docs:
            yield chunk()
    return run


CHUNKS = ("part int, seq int, first_doc long, last_doc long, dict_sha256 string, n_tokens long, "
          "doc_ids array<long>, tokens array<int>, offsets array<long>, payload binary")
NAMES = [c.split()[0] for c in CHUNKS.split(", ")]
TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]


def _train(path: str):
    def run(batches):
        samples, size = [], 0
        for batch in batches:
            for _, _, data, at in C.text_steps(C.column(batch, "text")):
                ids, off = Encoder.of(path).encode(data, at)
                for a, b in zip(off[:-1], off[1:], strict=True):
                    if size + 4 * (b - a) <= DICT_BYTES:
                        samples.append(ids[a:b].astype("<u4").tobytes())
                        size += 4 * (b - a)
        try:
            trained = zstandard.train_dictionary(DICT_SIZE, samples).as_bytes() if len(samples) >= 16 else b""
        except zstandard.ZstdError:  # samples too few or too alike for a dictionary
            trained = b""
        yield pa.RecordBatch.from_arrays([pa.array([trained], pa.binary())], names=["dictionary"])
    return run


def train_dictionary(docs: DataFrame, path: str, n: int) -> bytes:
    """Dictionary from the id arrays of a bounded hash sample, trained in one task; empty if
    the sample is too small."""
    share = min(1 << 20, max(1, (DICT_DOCS << 20) // max(n, 1)))
    sample = (docs.where((F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 20)) < share) & (F.octet_length("text") > 0))
              .orderBy(F.xxhash64("doc_id", F.lit(9)), "text").limit(DICT_DOCS).select("text"))
    trained = sample.mapInArrow(_train(path), "dictionary binary").agg(F.max("dictionary")).first()[0]
    return bytes(trained or b"")


def write(spark: SparkSession, docs: DataFrame, tokenizer: str, out: str) -> None:
    """Write the token store of ``docs(doc_id, text)`` to the folder ``out``.

    Null and empty texts are stored as the end id alone.  Repeated rows are each
    stored, next to each other; a null doc_id sorts first.  An empty table gives an empty store.
    Other columns are ignored.
    """
    C.prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(1, -(-(size or 0) // PART_BYTES), spark.sparkContext.defaultParallelism if (size or 0) > PART_BYTES else 1)
    dictionary = train_dictionary(docs, tokenizer, n)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary), tokenizer, END)], "dict_sha256 string, dictionary binary, tokenizer string, end_id int") \
        .write.parquet(f"{out}/dictionary")
    # part bounds from the ids alone; equal ids share a part
    cuts = docs.select(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 10 * parts)).first()[0] if parts > 1 else []
    part = F.coalesce(F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts or [])))), lambda c: c < F.col("doc_id"))), F.lit(0)) if cuts else F.lit(0)
    (docs.withColumn("part", part.cast("int")).repartitionById(parts, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "text")
     .mapInArrow(_write(tokenizer, dictionary, sha), CHUNKS)
     .write.option("compression", "uncompressed").parquet(f"{out}/chunks"))


def _read(dictionary: bytes, sha: str, with_ids: bool):
    def run(batches):
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpack = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_sha256"] != sha:
                    raise ValueError("chunk was written with another dictionary")
                body, off = row["payload"], row["offsets"]
                raw = [unpack.decompress(body[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
                n = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
                cols = [pa.array([row["part"]] * len(n), pa.int32()), pa.array([row["seq"]] * len(n), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()), pa.array(np.cumsum(n) - n), pa.array(n),
                        pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                if with_ids:
                    flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate((np.zeros(1, np.int64), np.cumsum(n))), pa.int32()), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(cols, names=["part", "seq", "doc_id", "near", "n_tokens", "ids_crc32", "ids"][:len(cols)])
    return run


def read(spark: SparkSession, out: str, with_ids: bool = False, doc_ids: tuple[int, int] | None = None) -> DataFrame:
    """Documents of a store: ``(doc_id, start, n_tokens, ids_crc32[, ids])``; ``start`` counts the ids of
    all documents before it.  ``doc_ids`` reads only the chunks of an id range."""
    C.prepare(spark)
    held = spark.read.parquet(f"{out}/dictionary").first()
    chunks = spark.read.schema(CHUNKS).parquet(f"{out}/chunks")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = chunks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), zero).alias("ahead"))
    base = (chunks.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), zero).alias("near")).join(parts, "part")
            .select("part", "seq", (F.col("ahead") + F.col("near")).alias("base")))
    if doc_ids:
        chunks = chunks.where((F.col("last_doc") >= doc_ids[0]) & (F.col("first_doc") <= doc_ids[1]))
    schema = "part int, seq int, doc_id long, near long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    rows = (chunks.select("part", "seq", "dict_sha256", "doc_ids", "offsets", "payload")
            .mapInArrow(_read(bytes(held["dictionary"]), held["dict_sha256"], with_ids), schema))
    if doc_ids:
        rows = rows.where(F.col("doc_id").between(*doc_ids))
    return (rows.join(base, ["part", "seq"])  # decoded rows move, payloads do not
            .select("doc_id", (F.col("base") + F.col("near")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])))


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the store to the shared folder and read every document back."""
    out = scratch_dir(spark, "tokens")
    write(spark, docs, tokenizer, out)
    return read(spark, out)
