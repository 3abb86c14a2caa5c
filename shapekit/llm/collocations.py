"""Phrase collocations with Misra-Gries summaries.

Texts fall into pieces at punctuation and line ends, pieces into words; n-grams stay inside pieces and
are counted per language.

1. **Summaries.**  A task counts the n-grams (first bits of their 64-bit hashes) of its texts and, whenever they fill its table, sends one
   summary per hash partition on.  A partition's summaries come to one task, one after the other, which merges them into one
   Misra-Gries summary: beyond its capacity, counters are lowered together and those at zero go.
   The capacity exceeds the partition's mass, bounded by the bytes of the texts, divided by the threshold, so no
   n-gram that occurs ``least`` times can be lost.  Should a partition hold more than its share, its summary grows
   rather than lower its counters by ``least`` in all.
2. **Exact counts.**  A second scan counts the n-grams that survive, picked by a bit map of fixed size that is sent
   to the tasks; the few others that share a bit go once their counts are whole.  N-grams travel as the hashes of their words (as
   numbers in a list of the distinct ones, a row), from which those of all their parts follow.  The counts are kept as a table of arrays, one row per hash partition and language.
3. **Scores.**  A table of fixed size tells at least how often a word or word pair occurs (the least count of all that share
   a slot), which bounds each phrase's score from above.  Exact scores, by joins with the counts of the parts, are worked out
   for the phrases whose bound reaches a threshold of their language.  If the ``top``-th of these is not above the
   threshold, it is lowered to that one's score (or, if too few were left, by more and more phrases) and the step is repeated;
   so what is left out could not have been among the first.
4. **Words.**  Only phrases that can be among a language's first ``top`` are read back as text, in a third
   scan with a bit map of their own; text decides among equal scores.

Memory of a task is bounded by its table (``TABLE`` n-grams) or its summary; no group is gathered.
Hash partitions are as many as the bytes ask for, several to a task.  Ranking takes the first of each salted part of a language,
then the first of these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

LONGEST = 3
LEAST = 10
TOP = 2000
#: a phrase goes if a longer one accounts for this many of a hundred of its occurrences
COVERED = 50

#: bytes that end a piece, and bytes that separate words
CUT = np.zeros(256, bool)
CUT[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
SEPARATOR = CUT.copy()
SEPARATOR[[0x20, 0x09]] = True

#: n-grams a task holds before it sends its counts on, in the first and in the second scan
TABLE, WORD_TABLE = 1 << 18, 1 << 18
#: text bytes per summary
PART_BYTES = 4 << 20
#: powers of two of what is sent to tasks: bits of the maps of survivors (16 MB) and of small tables (2 MB), slots of least counts (16 MB)
SURVIVOR_BITS, SMALL_BITS, SLOT_BITS = 27, 24, 22
#: bits of the hashes that summaries tell n-grams apart by; n-grams that share them only add to each other's counts there
SUMMARY_BITS = 40
#: phrases scored at first, as a multiple of ``top``, and by what it grows
TRIED, GROWTH = 4, 8
SALTS = 64
GROUPS = 64
#: scores at which a threshold may lie
EDGES = np.unique(np.floor(2 ** (np.arange(320) / 16))).astype(np.int64)
MANY = np.iinfo(np.int32).max

_U = np.uint64


def gram_key(words: list[np.ndarray], salt: np.ndarray) -> np.ndarray:
    """Hash of n-grams given as the hashes of their words, one array per place, in a language with that salt."""
    acc = salt ^ _U(len(words))
    m = 0xD6E8FEB86659FD93
    for w in words:
        acc = acc + w * _U(m)
        m = (m * 0xD6E8FEB86659FD93 + 2) & (2**64 - 1) | 1
    return C.mix(acc)


class Grams:
    """n-grams of a run of documents: ``keys[k]`` holds the hash of the k words from each word on, and
    ``valid[k]`` tells where those lie in one piece.  Keys of equal words differ between languages."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lang: np.ndarray, longest: int):
        data = C.LOWER[data]
        self.words = words = C.Words(data, off, SEPARATOR)
        self.hashes, self.doc = h, doc = words.hashes(), words.doc()
        piece = np.cumsum(CUT[data], dtype=np.int32)[words.start] if len(h) else np.zeros(0, np.int32)
        salt = lang_salt(lang)[doc]
        self.keys: list = [None]
        self.valid: list = [None]
        n = len(h)
        for k in range(1, longest + 1):
            key, ok = np.zeros(n, np.uint64), np.zeros(n, bool)
            m = max(n - k + 1, 0)
            if m:
                key[:m] = gram_key([h[j:j + m] for j in range(k)], salt[:m])
                ok[:m] = (piece[:m] == piece[k - 1:k - 1 + m]) & (doc[:m] == doc[k - 1:k - 1 + m])
            self.keys.append(key)
            self.valid.append(ok)

    def row(self, k: int, at: np.ndarray, longest: int) -> list[np.ndarray]:
        """Key, key of the first two words, length and word hashes (0: none) of the k-grams at ``at``."""
        none = np.zeros(len(at), np.uint64)
        return [self.keys[k][at], self.keys[min(k, 2)][at], np.full(len(at), k, np.uint64),
                *[self.hashes[at + j] if j < k else none for j in range(longest)]]


def lang_salt(lang: np.ndarray) -> np.ndarray:
    return C.mix(lang)


def planes(x: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones: sorted or small numbers then compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def numbers(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def coded(w: list[np.ndarray]) -> list[bytes]:
    """Word hashes of n-grams as bytes: per place the numbers of its words in a list of the distinct hashes, which comes last."""
    known, at = np.unique(np.concatenate(w), return_inverse=True)
    kind = np.min_scalar_type(max(len(known) - 1, 0))
    return [*[planes(x.astype(kind)) for x in np.split(at, len(w))], planes(known)]


def _narrow(n: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs."""
    return n.astype(np.min_scalar_type(int(n.max())))


def _wide(raw: bytes, rows: int) -> np.ndarray:
    return numbers(raw, np.dtype(f"u{len(raw) // max(rows, 1)}")).astype(np.int64)


def decoded(raw: list[bytes], rows: int) -> list[np.ndarray]:
    known = numbers(raw[-1], np.uint64)
    kind = np.min_scalar_type(max(len(known) - 1, 0))
    return [known[numbers(x, kind)] if rows else known[:0] for x in raw[:-1]]


def _codes(col: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Place of each row's language in the list of the batch's languages; null is ``und``."""
    enc = pc.dictionary_encode(col.cast(pa.string()).fill_null("und"))
    enc = enc.combine_chunks() if isinstance(enc, pa.ChunkedArray) else enc
    return enc.indices.to_numpy(zero_copy_only=False), enc.dictionary.to_pylist()


def _lang_hash(name: str) -> int:
    raw = np.frombuffer(name.encode(), np.uint8)
    return int(C.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]) if len(raw) else 1


def _steps(batches, longest: int):
    """Steps of all batches: n-grams, the language of each document as a place in its list, the list."""
    for batch in batches:
        code, names = _codes(C.column(batch, "lang"))
        hashes = np.array([_lang_hash(x) for x in names], np.uint64)
        for i, j, data, off in C.text_steps(C.column(batch, "text")):
            yield Grams(data, off, hashes[code[i:j]], longest), code[i:j], names


def _summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sums of their counts and the place of one row of each."""
    o = np.argsort(key, kind="stable")
    k = key[o]
    new = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
    return k[new], np.add.reduceat(count[o], new) if len(new) else count, o[new]


def _part_edges(parts: int) -> np.ndarray:
    """First hash of each hash partition: equal ranges of all hashes."""
    return np.array([-(-(i << 64) // parts) for i in range(parts)], np.uint64)


def _count_all(longest: int, table: int, parts: int):
    def run(batches):
        keys, counts, held = [], [], 0
        edges = _part_edges(parts) >> _U(64 - SUMMARY_BITS)

        def merged():
            key, n, _ = _summed(np.concatenate(keys), np.concatenate(counts))
            return key, n

        def told(key, n):
            """One summary per hash partition: its keys and counts as bytes."""
            at = np.append(np.searchsorted(key, edges), len(key))
            some = np.flatnonzero(np.diff(at))
            cut = lambda x: pa.array([planes(x[at[i]:at[i + 1]]) for i in some], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), cut(key), cut(n)], names=["part", "keys", "counts"])

        for g, _, _ in _steps(batches, longest):
            key = np.concatenate([g.keys[k][g.valid[k]] for k in range(1, longest + 1)]) >> _U(64 - SUMMARY_BITS)
            key, n = np.unique(key, return_counts=True)
            keys.append(key)
            counts.append(n.astype(np.int64))
            held += len(key)
            if held > 2 * table:
                key, n = merged()
                if len(key) > table:
                    yield told(key, n)
                    key, n = key[:0], n[:0]
                keys, counts, held = [key], [n], len(key)
        if held:
            yield told(*merged())
    return run


def _lowered(key: np.ndarray, n: np.ndarray, capacity: int, left: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Counters lowered together until at most ``capacity`` remain, by ``left`` at most."""
    if len(n) <= capacity or left <= 0:
        return key, n, 0
    by = int(min(np.partition(n, len(n) - 1 - capacity)[len(n) - 1 - capacity], left))
    stay = n > by
    return key[stay], n[stay] - by, by


class Summary:
    """Misra-Gries summary of ``counters``.  With more counters than mass / least, lowering all by one takes so much mass
    away that it happens less than ``least`` times; if it would have to happen again, the summary grows."""

    def __init__(self, least: int, counters: int):
        self.least, self.counters, self.lowered = least, counters, 0
        self.key, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list = []
        self.held = 0

    def add(self, key: np.ndarray, n: np.ndarray) -> None:
        self.waiting.append((key, n))
        self.held += len(key)
        if self.held > self.counters:
            self.merge()

    def merge(self) -> None:
        keys, counts = zip((self.key, self.n), *self.waiting, strict=True)
        self.key, self.n, _ = _summed(np.concatenate(keys), np.concatenate(counts))
        self.waiting, self.held = [], 0
        self.key, self.n, by = _lowered(self.key, self.n, self.counters, self.least - 1 - self.lowered)
        self.lowered += by

    def survivors(self) -> np.ndarray:
        """Keys that may occur ``least`` times."""
        self.merge()
        return self.key[self.n + self.lowered >= self.least]


def summarise(least: int, counters: int, bits: int):
    """Merge rows ``(part, keys, counts)``, sorted by part, into a summary per part; tells where the bits of the keys that may
    occur ``least`` times stand: ``(at, raw)``, bytes of the map from ``at`` on."""
    def run(batches):
        part, summary = None, None

        def told():
            at = np.unique(summary.survivors() >> _U(SUMMARY_BITS - bits)).astype(np.int64)
            if not len(at):
                return []
            first = int(at[0] >> 3)
            raw = np.zeros(int(at[-1] >> 3) - first + 1, np.uint8)
            np.bitwise_or.at(raw, (at >> 3) - first, (1 << (at & 7)).astype(np.uint8))
            return [pa.RecordBatch.from_arrays([pa.array([first]), pa.array([raw.tobytes()], pa.binary())], names=["at", "raw"])]

        for batch in batches:
            for i in range(batch.num_rows):
                if (now := batch.column(0)[i].as_py()) != part:
                    if summary:
                        yield from told()
                    part, summary = now, Summary(least, counters)
                summary.add(numbers(batch.column(1)[i].as_py(), np.uint64), numbers(batch.column(2)[i].as_py(), np.int64))
        if summary:
            yield from told()
    return run


def assembled(pieces: DataFrame, size: int, kind: type, empty: int) -> np.ndarray:
    """An array of fixed size from pieces ``(at, raw)`` of it: bits or least numbers where pieces meet.  Pieces are put
    together by ``GROUPS`` stretches first, so the driver receives that many rows."""
    def run(batches):
        group, out = None, None

        def told():
            some = np.flatnonzero(out != empty)
            return [(group * width + int(some[0]), out[some[0]:some[-1] + 1])] if len(some) else []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], pa.int64()), pa.array([x.tobytes() for _, x in rows], pa.binary())],
                                              names=["at", "raw"])
        for batch in batches:
            for i in range(batch.num_rows):
                now, at, raw = (c[i].as_py() for c in batch.columns)
                if now != group:
                    if group is not None and (rows := told()):
                        yield batch_of(rows)
                    group, out = now, np.full(width, empty, kind)
                new = np.frombuffer(raw, kind)
                a, b = max(at, now * width), min(at + len(new), (now + 1) * width)
                put = np.minimum if empty else np.bitwise_or
                mine = slice(a - now * width, b - now * width)
                out[mine] = put(out[mine], new[a - at:b - at])
        if group is not None and (rows := told()):
            yield batch_of(rows)

    width = -(-size // GROUPS)
    item = np.dtype(kind).itemsize
    last = F.floor((F.col("at") + F.octet_length("raw") / item - 1) / width)
    rows = (pieces.select(F.explode(F.sequence(F.floor(F.col("at") / width), last)).alias("stretch"), "at", "raw")
            .repartition("stretch").sortWithinPartitions("stretch").mapInArrow(run, "at long, raw binary"))
    out = np.full(width * GROUPS, empty, kind)
    for at, raw in rows.collect():
        new = np.frombuffer(raw, kind)
        out[at:at + len(new)] = new
    return out[:size]


def bit_map(keys: DataFrame, bits: int) -> np.ndarray:
    """Map of the first ``bits`` bits of the keys, as bytes."""
    at = keys.select((F.shiftrightunsigned("key", 64 - bits) + 1).alias("at")).select(
        F.bitmap_bucket_number("at").alias("block"), F.bitmap_bit_position("at").alias("bit"))
    rows = at.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("raw"))
    return assembled(rows.select(((F.col("block") - 1) * 4096).alias("at"), "raw"), 1 << (bits - 3), np.uint8, 0)


def _in_map(key: np.ndarray, held: np.ndarray, bits: int) -> np.ndarray:
    at = (key >> _U(64 - bits)).astype(np.int64)
    return (held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _count_some(longest: int, table: int, held, bits: int, parts: int):
    """Counts of the n-grams in the map, as rows of one hash partition (of their first two words) and language."""
    def run(batches):
        bitmap, edges = held.value, _part_edges(parts)
        rows, counts, langs, size = [], [], [], 0
        names: dict[str, int] = {}

        def merged():
            r, c, v = np.concatenate(rows, 1), np.concatenate(counts), np.concatenate(langs)
            _, n, at = _summed(r[0], c)
            return r[:, at], n, v[at]

        def told(r, n, v):
            told_names = list(names)
            for code in np.unique(v):
                mine = np.flatnonzero(v == code)
                place = np.searchsorted(edges, r[1][mine], "right") - 1
                # equal first words beside each other: their numbers then compress well
                o = np.lexsort((*r[:2:-1, mine], place))
                mine, place = mine[o], place[o]
                at = np.append(np.searchsorted(place, np.arange(parts)), len(mine))
                some = np.flatnonzero(np.diff(at))
                blocks = [mine[at[i]:at[i + 1]] for i in some]
                words = zip(*[coded([w[b] for w in r[3:]]) for b in blocks], strict=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(some.astype(np.int64)), pa.array([told_names[code]] * len(some), pa.string()),
                    pa.array([planes(_narrow(n[b])) for b in blocks], pa.binary()),
                    pa.array([planes(r[2][b].astype(np.uint8)) for b in blocks], pa.binary()),
                    *[pa.array(x, pa.binary()) for x in words]], names=[*_partial(longest), "known"])

        for g, code, of in _steps(batches, longest):
            place = np.array([names.setdefault(x, len(names)) for x in of], np.int64)
            for k in range(1, longest + 1):
                at = np.flatnonzero(g.valid[k])
                at = at[_in_map(g.keys[k][at], bitmap, bits)]
                if not len(at):
                    continue
                _, first, n = np.unique(g.keys[k][at], return_index=True, return_counts=True)
                at = at[first]
                rows.append(np.stack(g.row(k, at, longest)))
                counts.append(n.astype(np.int64))
                langs.append(place[code[g.doc[at]]])
                size += len(at)
            if size > 2 * table:
                r, n, v = merged()
                if r.shape[1] > table:
                    yield from told(r, n, v)
                    r, n, v = r[:, :0], n[:0], v[:0]
                rows, counts, langs, size = [r], [n], [v], r.shape[1]
        if size:
            yield from told(*merged())
    return run


def _partial(longest: int) -> list[str]:
    return ["part", "lang", "n", "k", *[f"w{j}" for j in range(longest)]]


def _whole_counts(longest: int, least: int, table: int, slot_bits: int):
    """Add up the rows of each hash partition and language, sorted by these; n-grams of ``least`` occurrences stay, as one row.
    A row of null language per partition has the least counts of its words and word pairs by slot, from slot ``n`` on."""
    def run(batches):
        where, waiting, held = None, [], 0
        slots: list = []

        def merged():
            k, n, *w = (np.concatenate(x) for x in zip(*waiting, strict=True))
            _, n, at = _summed(_keys(k, w, where[1]), n)
            return [(k[at], n, *[x[at] for x in w])]

        def told():
            (k, n, *w), = merged()
            some = n >= least
            k, n, w = k[some], n[some], [x[some] for x in w]
            short = k <= 2
            slots.append((_keys(k[short], [x[short] for x in w], where[1]) >> _U(64 - slot_bits), n[short]))
            return pa.RecordBatch.from_arrays([
                pa.array([where[0]]), pa.array([where[1]], pa.string()), *[pa.array([planes(x)], pa.binary()) for x in (n, k, *w)]], names=_partial(longest))

        def least_counts():
            at, n = (np.concatenate(x) for x in zip(*slots, strict=True))
            slots.clear()
            if not len(at):
                return []
            at = at.astype(np.int64)
            low = np.full(int(at.max() - at.min()) + 1, MANY, np.int32)
            np.minimum.at(low, at - at.min(), np.minimum(n, MANY).astype(np.int32))
            none = pa.nulls(1, pa.binary())
            return [pa.RecordBatch.from_arrays([pa.array([at.min()]), pa.nulls(1, pa.string()), pa.array([low.tobytes()], pa.binary()),
                                                *[none] * (1 + longest)], names=_partial(longest))]

        for batch in batches:
            for i in range(batch.num_rows):
                part, lang, n, k, *raw = (c[i].as_py() for c in batch.columns)
                if (part, lang) != where:
                    if waiting:
                        yield told()
                        if part != where[0]:
                            yield from least_counts()
                    where, waiting, held = (part, lang), [], 0
                waiting.append((numbers(k, np.uint8), _wide(n, len(k)), *decoded(raw, len(k))))
                held += len(waiting[-1][0])
                if held > 2 * table:
                    waiting = merged()
                    held = len(waiting[0][0])
                    if held > table:  # that many different n-grams: wait for as many again
                        held = 0
        if waiting:
            yield told()
            yield from least_counts()
    return run


def _keys(k: np.ndarray, w: list[np.ndarray], lang: str) -> np.ndarray:
    """Hashes of n-grams of mixed lengths."""
    salt = lang_salt(np.full(len(k), _lang_hash(lang), np.uint64))
    out = np.zeros(len(k), np.uint64)
    for size in np.unique(k):
        at = k == size
        out[at] = gram_key([x[at] for x in w[:size]], salt[at])
    return out


def _counted(batches):
    """Rows of the count table: language, further columns, lengths, counts, word hashes."""
    for batch in batches:
        names = batch.schema.names
        words = [j for j, c in enumerate(names) if c.startswith("w")]
        for i in range(batch.num_rows):
            row = {c: batch.column(j)[i].as_py() for j, c in enumerate(names)}
            yield (row["lang"], row, numbers(row["k"], np.uint8), numbers(row["n"], np.int64), [numbers(row[names[j]], np.uint64) for j in words])


def _bounds(lang: str, k: np.ndarray, n: np.ndarray, w: list[np.ndarray], least: int, slots: np.ndarray) -> np.ndarray:
    """A score that each phrase cannot exceed; -1 for single words."""
    out = np.full(len(k), np.inf)
    salt = lang_salt(np.full(len(k), _lang_hash(lang), np.uint64))

    def at_least(a, b, rows):
        if b - a > 2:
            return np.maximum(least, n[rows])
        key = gram_key([x[rows] for x in w[a:b]], salt[rows])
        return np.maximum(slots[(key >> _U(65 - len(slots).bit_length())).astype(np.int64)], n[rows])
    for size in np.unique(k):
        rows = np.flatnonzero(k == size)
        for cut in range(1, size):
            a = n[rows].astype(float)
            out[rows] = np.minimum(out[rows], 1e6 * a * a / (at_least(0, cut, rows).astype(float) * at_least(cut, size, rows)))
    return np.where(k > 1, np.floor(out * (1 + 1e-9)) + 1, -1)


def _spread(least: int, held):
    """Phrases per language and threshold below their bound."""
    def run(batches):
        for lang, _, k, n, w in _counted(batches):
            bound = _bounds(lang, k, n, w, least, held.value)
            per = np.bincount(np.searchsorted(EDGES, bound[k > 1], "right") - 1, minlength=len(EDGES))
            some = np.flatnonzero(per)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(EDGES[some]), pa.array(per[some].astype(np.int64))],
                                             names=["lang", "edge", "n"])
    return run


def _likely(longest: int, least: int, held):
    """Phrases whose bound reaches their language's threshold, with the keys of their first parts and rests."""
    def run(batches):
        for lang, row, k, n, w in _counted(batches):
            some = np.flatnonzero(_bounds(lang, k, n, w, least, held.value) >= max(row["tau"], 0))
            k, n, w = k[some], n[some], [x[some] for x in w]
            salt = lang_salt(np.full(len(k), _lang_hash(lang), np.uint64))
            firsts, rests = np.zeros((2, len(k), longest - 1), np.uint64)
            for size in np.unique(k):
                at = np.flatnonzero(k == size)
                for cut in range(1, size):
                    firsts[at, cut - 1] = gram_key([x[at] for x in w[:cut]], salt[at])
                    rests[at, cut - 1] = gram_key([x[at] for x in w[cut:size]], salt[at])
            off = pa.array(np.arange(len(k) + 1, dtype=np.int32) * (longest - 1))
            yield pa.RecordBatch.from_arrays([
                pa.array(_keys(k, w, lang).view(np.int64)), pa.array(k.astype(np.int32)), pa.array([lang] * len(k), pa.string()), pa.array(n),
                *[pa.ListArray.from_arrays(off, pa.array(x.view(np.int64).ravel())) for x in (firsts, rests)]],
                names=["key", "k", "lang", "a", "firsts", "rests"])
    return run


def _looked_up(needed, own, bits: int):
    """Counts of the n-grams in one map, and of the phrases one word longer than those in another, by these."""
    def run(batches):
        for lang, _, k, n, w in _counted(batches):
            salt = lang_salt(np.full(len(k), _lang_hash(lang), np.uint64))
            key = _keys(k, w, lang)
            some = np.flatnonzero(_in_map(key, needed.value, bits))
            out = [(key[some], n[some], np.zeros(len(some), np.int64))]
            for size in np.unique(k[k > 2]):
                at = np.flatnonzero(k == size)
                for a, b in ((0, size - 1), (1, size)):
                    part = gram_key([x[at] for x in w[a:b]], salt[at])
                    hit = _in_map(part, own.value, bits)
                    out.append((part[hit], np.zeros(int(hit.sum()), np.int64), n[at[hit]]))
            key, n, longer = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n), pa.array(longer)], names=["key", "a", "longer"])
    return run


def _read_words(longest: int, held, bits: int):
    """Texts of the n-grams in the map, once a step, and the number of words per language."""
    def run(batches):
        bitmap = held.value
        total: dict[str, int] = {}
        for g, code, of in _steps(batches, longest):
            per = np.bincount(code[g.doc], minlength=len(of))
            for name, n in zip(of, per, strict=True):
                total[name] = total.get(name, 0) + int(n)
            keys, texts = [], []
            for k in range(2, longest + 1):
                at = np.flatnonzero(g.valid[k])
                at = at[_in_map(g.keys[k][at], bitmap, bits)]
                key, first = np.unique(g.keys[k][at], return_index=True)
                keys.append(key)
                w = g.words
                texts += [b" ".join(w.data[w.start[i + j]:w.end[i + j]].tobytes() for j in range(k)) for i in at[first]]
            key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([
                pa.array(key.view(np.int64)), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()),
                pa.nulls(len(key), pa.string()), pa.nulls(len(key), pa.int64())], names=["key", "phrase", "lang", "n"])
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(total), pa.int64()), pa.nulls(len(total), pa.string()),
            pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["key", "phrase", "lang", "n"])
    return run


def _first(rows: DataFrame, order: list, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their ``rank``, after a cut in salted parts of it."""
    part = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    whole = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS))).withColumn("rank", part).where(F.col("rank") <= top)
            .drop("salt").withColumn("rank", whole).where(F.col("rank") <= top))


def _scored(spark: SparkSession, counts: DataFrame, tau: DataFrame, slots, longest: int, least: int, covered: int) -> DataFrame:
    """Exact scores of the phrases whose bound reaches ``tau(lang, tau)``, without those that longer ones cover."""
    likely = counts.join(tau, "lang").mapInArrow(_likely(longest, least, slots),
                                                 "key long, k int, lang string, a long, firsts array<long>, rests array<long>")
    likely = C.store(spark, likely, "phrases-likely")
    cuts = (likely.select("key", "k", "a", F.posexplode(F.arrays_zip("firsts", "rests")).alias("cut", "part"))
            .where("cut < k - 1").select("key", "a", "cut", F.col("part.firsts").alias("first"), F.col("part.rests").alias("rest")))
    send = lambda keys: spark.sparkContext.broadcast(bit_map(keys, SMALL_BITS))
    needed = cuts.select(F.explode(F.array("first", "rest")).alias("key")).distinct()
    found = counts.mapInArrow(_looked_up(send(needed), send(likely), SMALL_BITS), "key long, a long, longer long")
    # a part one word shorter occurs at least as often, so those two parts of each phrase decide for all its parts
    found = C.store(spark, found.groupBy("key").agg(F.max("a").alias("a"), F.max("longer").alias("longer")), "phrases-found")
    cuts = (cuts.join(found.select(F.col("key").alias("first"), F.col("a").alias("l")), "first")
            .join(found.select(F.col("key").alias("rest"), F.col("a").alias("r")), "rest"))
    whole = lambda c: F.col(c).cast("decimal(15,0)")
    cuts = cuts.select("key", "cut", "l", "r", (F.lit(1_000_000).cast("decimal(7,0)") * (whole("a") * whole("a"))).alias("up"),
                       (whole("l") * whole("r")).alias("down")).withColumn("score", F.expr("up div down"))
    best = cuts.groupBy("key").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")).select("key", "best.score", "best.l", "best.r")
    judged = (likely.select("key", "lang", "a").join(best, "key").join(found.select("key", "longer"), "key", "left")
              .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)).drop("longer"))
    return C.store(spark, judged, "phrases-judged")


def collocations(spark: SparkSession, docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP,
                 covered: int = COVERED) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of two to ``longest`` words of each
    language of ``docs(text, lang)``, by score, then occurrences, then text.

    ``a`` occurrences of the phrase, ``l`` and ``r`` of its first part and rest at the cut of the
    least score, ``n`` words of the language, ``score`` floor(1,000,000 a a / (l r)) in exact decimals.

    Null or empty texts have no words, a null language is ``und``; rows without phrases of ``least`` occurrences
    or an empty table give no rows.  Repeated rows count as often as they stand.  Very long texts are one
    step of a task.  Other columns are ignored.
    """
    C.prepare(spark)
    # texts are scanned in the order they lie; only these two columns are read
    docs = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, int(-(-size // PART_BYTES)))
    counters = max(1 << 16, longest * int(size) // (2 * parts * least) + 1)  # a word and its end take two bytes at least

    seen = docs.mapInArrow(_count_all(longest, TABLE, parts), "part long, keys binary, counts binary")
    survivors = seen.repartition("part").sortWithinPartitions("part").mapInArrow(summarise(least, counters, SURVIVOR_BITS), "at long, raw binary")
    survivors = assembled(C.store(spark, survivors, "phrases-survivors"), 1 << (SURVIVOR_BITS - 3), np.uint8, 0)
    held = spark.sparkContext.broadcast(survivors)
    schema = "part long, lang string, n binary, k binary, " + ", ".join(f"w{j} binary" for j in range(longest))
    counts = (docs.mapInArrow(_count_some(longest, WORD_TABLE, held, SURVIVOR_BITS, parts), schema + ", known binary")
              .repartition("part").sortWithinPartitions("part", "lang").mapInArrow(_whole_counts(longest, least, WORD_TABLE, SLOT_BITS), schema))
    counts = C.store(spark, counts, "phrases-counts")
    pieces = counts.where("lang IS NULL").select(F.col("part").alias("at"), F.col("n").alias("raw"))
    slots = spark.sparkContext.broadcast(assembled(pieces, 1 << SLOT_BITS, np.int32, MANY))
    counts = counts.where("lang IS NOT NULL")

    spread = counts.mapInArrow(_spread(least, slots), "lang string, edge long, n long").groupBy("lang", "edge").agg(F.sum("n").alias("n"))
    spread = C.store(spark, spread, "phrases-spread")  # as many rows a language as thresholds
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.col("edge").desc()))
    spread = spread.withColumn("above", above)

    def threshold(phrases: int) -> DataFrame:
        """The highest threshold that so many bounds reach, 0 where there are fewer."""
        return spread.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("above") >= phrases, F.col("edge"))), F.lit(0)).alias("tau"))

    tried, tau = TRIED * top, threshold(TRIED * top)
    while True:
        tau = C.store(spark, tau, "phrases-tau")
        judged = _scored(spark, counts, tau, slots, longest, least, covered)
        tried *= GROWTH
        # the score of the top-th phrase of each language
        reached = (_first(judged, [F.col("score").desc(), "key"], top).where(F.col("rank") == top).select("lang", F.col("score").alias("reached")))
        state = tau.join(reached, "lang", "left").join(threshold(tried).withColumnRenamed("tau", "more"), "lang")
        settled = (F.col("tau") == 0) | F.coalesce(F.col("reached") >= F.col("tau"), F.lit(False))
        state = C.store(spark, state.select("lang", settled.alias("settled"), F.when(settled, F.col("tau")).otherwise(
            F.coalesce("reached", "more")).alias("tau")), "phrases-state")
        if state.where("NOT settled").isEmpty():
            break
        tau = state.select("lang", "tau")

    order = [F.col("score").desc(), F.col("a").desc()]
    last = _first(judged, [*order, "key"], top).groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"))
    finalists = (judged.join(last, "lang").where(F.struct("score", "a") >= F.col("last")).drop("last"))
    finalists = C.store(spark, finalists, "phrases-finalists")
    named = spark.sparkContext.broadcast(bit_map(finalists, SMALL_BITS))
    read = C.store(spark, docs.mapInArrow(_read_words(longest, named, SMALL_BITS), "key long, phrase string, lang string, n long"),
                   "phrases-words")
    words = read.where("key is not null").groupBy("key").agg(F.min("phrase").alias("phrase"))
    sizes = read.where("key is null").groupBy("lang").agg(F.sum("n").alias("n"))
    told = _first(finalists.join(words, "key"), [*order, "phrase"], top).join(sizes, "lang")
    return told.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
