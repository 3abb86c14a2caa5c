"""Assemble streamed answer chunks per request and emit the JSON object as
soon as its braces balance.

Requests are dealt into shards by the hash of their key, and each shard's requests are
one state entry, read and written by one call per micro-batch: a call costs milliseconds,
whatever it does.  State per open request: nesting depth, whether the text so far ends
inside a string or right after a backslash, the text from the first ``{`` on, the next expected
``seq``, chunks that arrived early, and when it times out.  Chunks are applied strictly in
``seq`` order, whatever order the micro-batches deliver them in.  A request ends as ``complete`` when
depth returns to zero, as ``no_json`` when its last chunk arrives without a
balanced object, or when it stays silent past the time-out.

A chunk is read by jumping from one quote, backslash or brace to the next; pieces are
joined once, on completion.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTPUT_SCHEMA = "idx long, json_str string, status string, detail string"
STATE_SCHEMA = ("open array<struct<idx long, depth int, quoted boolean, escaped boolean, text string, next_seq int, "
                "due long, early array<struct<seq int, text string, last boolean>>>>, "
                "ended array<struct<idx long, due long>>")
SHARD_REQUESTS = 100  # requests of a shard: so many times fewer calls, and so many requests held at a time

_IN_STRING = re.compile(r'["\\]')
_IN_OBJECT = re.compile(r'["{}]')


@dataclass
class Progress:
    """What is known of one object after some of its text."""

    depth: int = 0
    quoted: bool = False
    escaped: bool = False
    pieces: list = field(default_factory=list)

    def feed(self, chunk: str) -> str | None:
        """Take the next text; the whole object once its last brace is in, else None."""
        begin = at = 0
        if not self.pieces:
            begin = chunk.find("{")
            if begin < 0:
                return None
            at = begin
        elif self.escaped and chunk:
            at, self.escaped = 1, False
        while m := (_IN_STRING if self.quoted else _IN_OBJECT).search(chunk, at):
            at = m.end()
            match m[0]:
                case '"':
                    self.quoted = not self.quoted
                case "\\":
                    self.escaped = at == len(chunk)
                    at += 1
                case "{":
                    self.depth += 1
                case "}":
                    self.depth -= 1
                    if not self.depth:
                        return "".join([*self.pieces, chunk[begin:at]])
        self.pieces.append(chunk[begin:])
        return None


@dataclass
class Request:
    """A request that has not ended."""

    at: Progress = field(default_factory=Progress)
    next_seq: int = 0
    due: int = 0
    early: dict = field(default_factory=dict)

    def advance(self) -> tuple | None:
        """Apply the chunks that are next in turn; (json_str, status, detail) once the request ends, else None."""
        while self.next_seq in self.early:
            text, last = self.early.pop(self.next_seq)
            self.next_seq += 1
            found = self.at.feed(text)
            if found is not None:
                return found, "complete", None
            if last:
                return None, "no_json", "unclosed" if self.at.pieces else "no_brace"
        return None

    def stored(self, idx: int) -> tuple:
        at = self.at
        return (idx, at.depth, at.quoted, at.escaped, "".join(at.pieces), self.next_seq, self.due,
                [(q, *self.early[q]) for q in sorted(self.early)])


def _restored(depth, quoted, escaped, text, next_seq, due, early) -> Request:
    return Request(Progress(depth, quoted, escaped, [text] if text else []), next_seq, due,
                   {q: (chunk, last) for q, chunk, last in early})


def _assemble(timeout_ms: int):
    def fn(key, pdfs, state):
        now, requests, ended, out = state.getCurrentWatermarkMs(), {}, {}, []
        if state.exists:
            rows, tombstones = state.get
            requests = {idx: _restored(*row) for idx, *row in rows}
            ended = dict(map(tuple, tombstones))
        # chunks may arrive out of order across and within micro-batches:
        # keep early ones until the chunks before them are in
        for pdf in () if state.hasTimedOut else pdfs:
            arrived = pdf["ts"].astype("datetime64[ms]").astype("int64")
            for i, q, text, last, ms in zip(pdf["idx"], pdf["seq"], pdf["chunk"], pdf["is_last"], arrived, strict=True):
                idx, due = int(i), max(int(ms) + timeout_ms, now + 1)
                if idx in ended:
                    ended[idx] = max(ended[idx], due)
                    continue
                r = requests.setdefault(idx, Request())
                r.due = max(r.due, due)
                if int(q) >= r.next_seq:
                    r.early[int(q)] = (text or "", bool(last))
        for idx, r in list(requests.items()):
            end = r.advance()
            if end:
                ended[idx] = r.due
            elif r.due < now:  # silent past the time-out: what arrived holds no object
                end = (None, "no_json", "timeout")
            if end:
                out.append((idx, *end))
                del requests[idx]
        # finished requests keep a small tombstone until the time-out, so
        # chunks still in flight do not start a new object
        ended = {idx: due for idx, due in ended.items() if due >= now}
        if requests or ended:
            state.update(([r.stored(idx) for idx, r in requests.items()], list(ended.items())))
            state.setTimeoutTimestamp(min([*ended.values(), *(r.due for r in requests.values())]))
        else:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["idx", "json_str", "status", "detail"])
    return fn


def shards_for(requests: int) -> int:
    """Shards for so many requests open or just ended at a time."""
    return max(1, -(-requests // SHARD_REQUESTS))


def assemble_stream(chunks: DataFrame, key: str = "idx", ts: str = "ts", timeout: str = "60 seconds",
                    timeout_ms: int = 60_000, shards: int = 1024) -> DataFrame:
    """(idx, seq, chunk, is_last, ts) stream -> (idx, json_str, status, detail), append mode.

    Event-time time-outs under a watermark on the arrival time ``ts``: a
    processing-time time-out would keep an ``availableNow`` run alive.
    A checkpoint keeps the ``shards`` it was created with (see ``shards_for``): another number would
    look for open requests in other shards.
    """
    x = chunks.select(F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard"), F.col(key).alias("idx"),
                      "seq", "chunk", "is_last", F.col(ts).alias("ts"))
    return (x.withWatermark("ts", timeout).groupBy("shard")
            .applyInPandasWithState(_assemble(timeout_ms), OUTPUT_SCHEMA, STATE_SCHEMA,
                                    "append", "EventTimeTimeout"))


def use_rocksdb_state(spark) -> None:
    """Keep per-request state in RocksDB (off the JVM heap) for streams started
    after this call; a checkpoint keeps the provider it was created with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def chunk_answers(answers: DataFrame, size: int = 16, raw: str = "raw", key: str = "idx") -> DataFrame:
    """Cut answers into ``size``-character chunks: (idx, seq, chunk, is_last, ts)."""
    # an answer is made once and cut once: both are read twice, as columns of steps of their own
    parts = F.regexp_extract_all(F.col(raw), F.lit("(?s).{1," + str(size) + "}"), 0)
    x = answers.select(key, F.when(F.col(raw) == "", F.array(F.lit(""))).otherwise(parts).alias("_parts"))
    x = x.select(key, "_parts", F.size("_parts").alias("_n"))
    # the plain form would test the pieces' number below, on answers made and cut anew for it
    x = x.select(key, "_n", F.posexplode_outer("_parts").alias("seq", "chunk")).filter(F.col("seq").isNotNull())
    # arrival time: one chunk per second from a fixed start
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("seq"))
    return x.select(key, "seq", "chunk", (F.col("seq") == F.col("_n") - 1).alias("is_last"), ts.alias("ts"))
