"""Records that run over several lines, read from file splits without moving their text.

A large file is read as lines by many tasks, each with one or more byte ranges (splits) of it in order.  A
``Cutter`` walks the lines of a split and cuts them into records.  What a split cannot know by itself is

* the state it begins in (inside a quoted cell, at some depth of brackets): a first job leaves one small row per
  split, the driver adds these up in file order, and each task looks up its splits' states (eight bytes and a hash
  a split, some megabytes for 100 TB);
* what came before its first cut and what follows its last: those two fragments per split are the only text that is
  shuffled, to be joined in file order.

Records in between leave the task whole.  So text is scanned, never exchanged, whatever the size of a file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapekit.session import scratch_dir

WHOLE, REST_OF_EARLIER, OPEN = 0, 1, 2
PIECES = "file string, block long, n long, kind int, value string"


class Cutter:
    """Cuts the lines of one split.  ``feed`` takes columns of lines in order and returns the pieces that end in them:
    the first piece of a split is what remains of an earlier record (None: nothing), each other one a record.  ``rest``
    is the open piece."""

    def begin(self, state: int) -> None:
        raise NotImplementedError

    def feed(self, *columns: pa.Array) -> list[str | None]:
        raise NotImplementedError

    def rest(self) -> str:
        raise NotImplementedError


def split_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """(split, file, block, value): the lines under ``path``, bytes that are no UTF-8 replaced; ``split`` identifies file
    and byte range."""
    reader = spark.read.option("encoding", "UTF-8")
    lines = (reader.option("lineSep", line_sep) if line_sep else reader).text(path)
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return lines.select(F.xxhash64(file, block).alias("split"), file.alias("file"), block.alias("block"),
                        F.make_valid_utf8("value").alias("value"))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Slices of the batches that lie in one split, and whether a slice begins it."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(batch.schema.get_field_index("split")).to_numpy()
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a), key[a] != last
            last = key[a]


def states(rows: DataFrame, step: Callable[[int, tuple], int], start: int = 0) -> dict[int, int]:
    """The state each split begins in, from one row ``(split, file, block, ...)`` per split: ``step`` takes
    the state before a split and its row's further values and gives the state after it."""
    found = rows.withColumn("file", F.xxhash64("file")).collect()
    out, file, state = {}, None, start
    for split, name, _, *values in sorted(found, key=lambda r: (r[1], r[2])):
        if name != file:
            file, state = name, start
        out[split] = state
        state = step(state, tuple(values))
    return out


def _cut(make: Callable[[], Cutter], columns: list[str], held, fragments: bool):
    def run(batches):
        cutter, where, cuts = None, None, 0

        def told(rows):
            """Rows of (place in the split, kind, text)."""
            place, kind, text = (list(x) for x in zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([
                pa.array([where[0]] * len(rows), pa.string()), pa.array([where[1]] * len(rows), pa.int64()),
                pa.array(place, pa.int64()), pa.array(kind, pa.int32()), pa.array(text, pa.string())],
                names=["file", "block", "n", "kind", "value"])

        def ended():  # an open record counts even if nothing of it is in this split yet
            return [told([(cuts, OPEN if cuts else REST_OF_EARLIER, cutter.rest())])] if cutter and fragments else []

        for batch, fresh in runs(batches):
            column = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
            if fresh:
                yield from ended()
                cutter, cuts, where = make(), 0, [column("file")[0].as_py(), column("block")[0].as_py()]
                cutter.begin(held.value.get(column("split")[0].as_py(), 0) if held else 0)
            rows = []
            for piece in cutter.feed(*map(column, columns)):
                kind = WHOLE if cuts else REST_OF_EARLIER
                if piece is not None and (kind == REST_OF_EARLIER) == fragments:
                    rows.append((cuts, kind, piece))
                cuts += 1
            if rows:
                yield told(rows)
        yield from ended()
    return run


def records(lines: DataFrame, make: Callable[[], Cutter], columns: list[str], start: dict[int, int] | None = None,
            joint: str = "\n") -> DataFrame:
    """(file, block, n, crossing, value): the records of ``lines``, ordered by file, block and n (1 for the first record
    that begins in a split; 0 in a file's first split is the text before any record).  ``crossing``: joined from several splits.

    ``columns`` of the lines go to the cutter ``make`` builds for each split; ``start`` has the splits' first
    states.  Pieces of a record that crosses splits are joined by ``joint``."""
    spark = lines.sparkSession
    held = spark.sparkContext.broadcast(start) if start else None
    lines = lines.select("split", "file", "block", *[c for c in columns if c not in ("split", "file", "block")])
    whole = lines.mapInArrow(_cut(make, columns, held, False), PIECES)
    # two rows a split at most, written so that their order is found on the keys alone
    path = scratch_dir(spark, "fragments")
    lines.mapInArrow(_cut(make, columns, held, True), PIECES).write.parquet(path)
    ends = spark.read.schema(PIECES).parquet(path)
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of = ends.select("file", "block", "kind", F.sum((F.col("kind") == OPEN).cast("int")).over(order).alias("record"))
    crossing = (ends.join(of, ["file", "block", "kind"]).groupBy("file", "record")
                .agg(F.sort_array(F.collect_list(F.struct("block", "kind", "n", "value"))).alias("p"))
                .select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["n"].alias("n"),
                        F.lit(True).alias("crossing"), F.array_join(F.transform("p", lambda x: x["value"]), joint).alias("value")))
    return whole.select("file", "block", "n", F.lit(False).alias("crossing"), "value").unionByName(crossing)


# ---- quoted cells --------------------------------------------------------------------------------

_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_CELLS = rf'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+)?,)*+'
_OPENS = rf'{_CELLS}"{_QUOTED}\z'


def quote_steps(line: Column) -> tuple[Column, Column]:
    """Whether a line that begins outside, inside a quoted cell ends inside one.  Only a quote at the start of a cell
    opens it, and doubled quotes stay inside."""
    return (F.regexp_like(line, F.lit(r"\A" + _OPENS)),
            F.regexp_like(line, F.lit(rf'\A{_QUOTED}(?:\z|"[^,]*+,{_OPENS})')))


def inside_before(outside: np.ndarray, inside: np.ndarray, state: int) -> np.ndarray:
    """The state before each line, and after the last: lines either set a state whatever came before, or keep or flip it."""
    n = len(outside)
    sets = outside == inside
    at = np.maximum.accumulate(np.where(sets, np.arange(n), -1))
    flips = np.concatenate(([0], np.cumsum(outside & ~inside)))
    base = np.where(at >= 0, outside[at], bool(state))
    after = base ^ ((flips[1:] - np.where(at >= 0, flips[at + 1], 0)) % 2 == 1)
    return np.concatenate(([bool(state)], after))


class QuotedLines(Cutter):
    """A record begins with each line that begins outside of a quoted cell."""

    def begin(self, state):
        self.state, self.open = state, []

    def feed(self, value, outside, inside):
        before = inside_before(outside.to_numpy(zero_copy_only=False), inside.to_numpy(zero_copy_only=False), self.state)
        self.state = int(before[-1])
        lines, out = value.to_pylist(), []
        starts = np.flatnonzero(~before[:-1]).tolist()
        if not starts:
            self.open += lines
            return out
        earlier = [*self.open, *lines[:starts[0]]]
        out.append("\n".join(earlier) if earlier else None)
        out += [lines[a] if b == a + 1 else "\n".join(lines[a:b]) for a, b in zip(starts, starts[1:])]
        self.open = lines[starts[-1]:]
        return out

    def rest(self):
        return "\n".join(self.open)


def _quote_effect(batches):
    """One row per split: the state after it for each state before it."""
    where, effect = None, [0, 1]

    def told():
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*where, *effect)], names=["split", "file", "block", "outside", "inside"])
    for batch, fresh in runs(batches):
        if fresh:
            if where:
                yield told()
            where, effect = [batch.column(k)[0].as_py() for k in range(3)], [0, 1]
        steps = [batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4)]
        effect = [int(inside_before(*steps, s)[-1]) for s in effect]
    if where:
        yield told()


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, n, crossing, value): CSV records whose quoted cells may hold line breaks (``\\r`` before an end goes)."""
    lines = split_lines(spark, path, "\n")
    outside, inside = quote_steps(F.regexp_replace("value", r"\r\z", ""))
    lines = lines.select("*", outside.alias("outside"), inside.alias("inside"))
    effects = lines.select("split", "file", "block", "outside", "inside").mapInArrow(
        _quote_effect, "split long, file string, block long, outside long, inside long")
    start = states(effects, lambda s, effect: effect[s])
    found = records(lines, QuotedLines, ["value", "outside", "inside"], start)
    return found.withColumn("value", F.regexp_replace("value", r"\r\z", ""))


# ---- JSON arrays ---------------------------------------------------------------------------------

_STRUCTURE = r'"(?:[^"\\]++|\\.)*+"|[^{}\[\],"]++'


class ArrayElements(Cutter):
    """Cuts at the array's start, at its commas and at its end.  JSON strings hold no line breaks, so a line begins
    outside of them; ``shape`` has the line's brackets and commas outside of strings."""

    def begin(self, state):
        self.depth, self.open = state, []

    def feed(self, value, shape):
        import re
        token = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\],]')
        out = []
        for line, s in zip(value.to_pylist(), shape.to_pylist(), strict=True):
            depth, cut = self.depth, False
            for c in s:
                if c == ",":
                    cut |= depth == 1
                elif c in "{[":
                    cut |= depth == 0
                    depth += 1
                elif c in "}]":
                    depth -= 1
                    cut |= depth == 0
            if not cut:
                self.open.append(line)
                self.depth = depth
                continue
            at = 0
            for m in token.finditer(line):
                c = m[0]
                if c in "{[":
                    self.depth += 1
                    border = self.depth == 1
                elif c in "}]":
                    self.depth -= 1
                    border = self.depth == 0
                else:
                    border = c == "," and self.depth == 1
                if border:
                    out.append("\n".join([*self.open, line[at:m.start()]]))
                    self.open, at = [], m.end()
            self.open.append(line[at:])
        return [x.strip() for x in out]

    def rest(self):
        return "\n".join(self.open).strip()


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, n, crossing, value): the elements, as JSON text, of files that each hold one array."""
    lines = split_lines(spark, path).withColumn("shape", F.regexp_replace("value", _STRUCTURE, ""))
    opens, closes = (F.length(F.regexp_replace("shape", p, "")) for p in (r"[^{\[]", r"[^}\]]"))
    deltas = lines.groupBy("split", "file", "block").agg(F.sum(opens - closes).alias("d"))
    return records(lines, ArrayElements, ["value", "shape"], states(deltas, lambda s, d: s + d[0])).filter("trim(value) <> ''")


# ---- marked records ------------------------------------------------------------------------------

#: characters of a mark before its white space
LONGEST_START = 3


class Marked(Cutter):
    """Cuts before each match of a pattern, which may run over line ends after its first ``LONGEST_START`` characters."""

    def __init__(self, pattern: str):
        import re
        self.mark = re.compile(pattern)

    def begin(self, state):
        self.text = None

    def feed(self, value):
        # a mark may have begun at the end of the text so far
        again = 0 if self.text is None else max(0, len(self.text.rstrip()) - LONGEST_START)
        text = "\n".join([*([] if self.text is None else [self.text]), *value.to_pylist()])
        at = [m.start() for m in self.mark.finditer(text, again)]
        out = [text[a:b] for a, b in zip([0, *at], at)]
        self.text = text[at[-1]:] if at else text
        return out

    def rest(self):
        return self.text or ""


def marked_records(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(file, block, n, crossing, value): lines from each match of ``pattern`` to the next, joined by line ends.  Text before a
    file's first match is a record of its own; one that crosses splits may hold further matches at the border."""
    return records(split_lines(spark, path), lambda: Marked(pattern), ["value"])
