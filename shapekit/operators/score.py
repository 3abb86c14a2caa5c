"""Batch scoring with a user-supplied model function.

The model is text -> text and is the user's business (decoding settings,
weights, device).  Spark partitions the prompts; ``mapInArrow`` builds the
model once per partition and feeds it steps of bounded rows and bytes, so a task
holds a step's prompts and answers, whatever the table's size.  Retries re-score only
the rows that failed validation.  Each attempt's answers are a table written before they are judged,
and the judged rows are a table too, so later jobs neither call the model nor validate again.
A task that is lost while it asks does ask its rows again; ``score_requests`` bounds what that can
be and carries answers over from one run to the next.
"""

from __future__ import annotations

import random
import time
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapekit.operators import validate as V
from shapekit.session import path_exists, scratch_dir


@dataclass(frozen=True)
class Attempt:
    """One scoring pass: system text and new-token limit."""

    system: str
    max_new_tokens: int


#: rows and text bytes of prompts that a task holds as Python strings at once (a longer single prompt is one step)
STEP_ROWS, STEP_BYTES = 256, 1 << 20
# Rows and bytes of the Arrow batches that such a task receives.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


@contextmanager
def _small_batches(spark):
    """Arrow batches of bounded size for the jobs started inside."""
    before = {k: spark.conf.get(k, None) for k in BATCHES}
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _steps(batches, text: str):
    """(rows, texts): slices of the batches of bounded rows and text bytes, with their texts (null: None)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        end = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        a = 0
        while a < len(col):
            b = int(np.searchsorted(end, (end[a - 1] if a else 0) + STEP_BYTES, "right"))
            b = min(max(b, a + 1), a + STEP_ROWS, len(col))
            yield batch.slice(a, b - a), col.slice(a, b - a).to_pylist()
            a = b


def _with(rows: pa.RecordBatch, columns: list, **more: list) -> pa.RecordBatch:
    """Those columns of the rows, and further ones of strings."""
    kept = [rows.column(rows.schema.get_field_index(c)) for c in columns]
    return pa.RecordBatch.from_arrays([*kept, *[pa.array(v, pa.string(), from_pandas=True) for v in more.values()]], names=[*columns, *more])


def _written(df: DataFrame, path: str | None, name: str) -> DataFrame:
    """Written once and read back, so later jobs (or a lost executor's
    recomputation) never call the model or service again."""
    path = path or scratch_dir(df.sparkSession, name)
    with _small_batches(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def score(df: DataFrame, make_model, text: str = "text", out: str = "raw", system: str = "",
          max_new_tokens: int = 700, user_prefix: str = "", partitions: int | None = None,
          path: str | None = None, user_suffix: str = "") -> DataFrame:
    """Adds ``out`` = model(user_prefix + text + user_suffix) for every row.

    ``make_model()`` is called once per partition and returns
    ``fn(prompts: list[str], max_new_tokens: int, system: str) -> list[str]``.
    ``partitions`` bounds how many model copies load (``repartition(k)``);
    the answers are a table written to ``path`` (default: the shared checkpoint folder).
    """
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType())])
    columns = df.columns

    def run(batches):
        fn = make_model()
        for rows, texts in _steps(batches, text):
            prompts = [user_prefix + ("" if t is None else t) + user_suffix for t in texts]
            yield _with(rows, columns, **{out: list(fn(prompts, max_new_tokens, system))})

    d = df.repartition(partitions) if partitions else df
    return _written(d.mapInArrow(run, schema), path, "scored")


def score_with_retry(df: DataFrame, make_model, attempts, mode: str = V.STRICT, key=("idx",),
                     text: str = "text", user_prefix: str = "", path: str | None = None,
                     partitions: int | None = None, user_suffix: str = "") -> DataFrame:
    """Score, validate, re-score failed rows only with the next attempt's set-up.

    Returns every attempt's validated rows with an ``attempt`` column (1-based);
    ``validate.pick_attempt`` turns them into one row per key.  Each attempt's
    raw answers are written to ``path`` (default: the shared checkpoint
    folder) and read back before validation.
    """
    spark = df.sparkSession
    base = path or scratch_dir(spark, "attempts")
    todo = df
    done = []
    for i, at in enumerate(attempts, start=1):
        scored = score(todo, make_model, text, "raw", at.system, at.max_new_tokens, user_prefix, partitions,
                       f"{base.rstrip('/')}/attempt={i}", user_suffix)
        # judged once: the rows to ask again and the result both read this table
        v = _written(V.validate(scored, mode).withColumn("attempt", F.lit(i)), f"{base.rstrip('/')}/judged={i}", "judged")
        done.append(v)
        if i < len(attempts):
            todo = v.filter(~F.col("ok")).select(*df.columns)
    res = done[0]
    for v in done[1:]:
        res = res.unionByName(v)
    return res


def request_key(prompt, system: str, max_new_tokens: int):
    """Identity of a request: a hash of its prompt and settings."""
    return F.sha2(F.concat_ws("\u0001", F.lit(system), F.lit(str(max_new_tokens)), prompt), 256)


ANSWERS = "request string, answer string, run string"


def score_requests(df: DataFrame, make_model, store: str, text: str = "text", out: str = "raw", system: str = "",
                   max_new_tokens: int = 700, user_prefix: str = "", user_suffix: str = "", partitions: int = 8,
                   chunk_rows: int = 1000, run: str = "") -> DataFrame:
    """``score`` over a table of answers (``store``) that outlives the run: adds ``out`` and ``run``.

    Requests are told apart by prompt and settings (``request_key``).  Those without a stored answer are asked
    once each, however many rows share them, in jobs of ``partitions`` x ``chunk_rows`` requests, and each job's
    answers are committed to ``store`` before the next starts.  So a lost task asks at most ``chunk_rows`` requests again, a
    run that broke off goes on where it stood, and a changed prompt or setting is a new request.
    ``run`` names the run that asked.  Null texts are empty prompts.
    """
    spark = df.sparkSession
    prompt = F.concat(F.lit(user_prefix), F.coalesce(F.col(text), F.lit("")), F.lit(user_suffix))
    keyed = df.withColumn("_request", request_key(prompt, system, max_new_tokens))
    todo = keyed.select(F.col("_request").alias("request"), prompt.alias("prompt")).dropDuplicates(["request"])
    known = spark.read.schema(ANSWERS).parquet(store) if path_exists(spark, store) else spark.createDataFrame([], ANSWERS)
    todo = todo.join(known.select("request"), "request", "left_anti")
    open_ = scratch_dir(spark, "requests")
    todo.write.parquet(open_)
    todo = spark.read.schema("request string, prompt string").parquet(open_)
    jobs = -(-todo.count() // (partitions * chunk_rows))

    def ask(batches):
        fn = make_model()
        for rows, prompts in _steps(batches, "prompt"):
            yield _with(rows, ["request"], answer=list(fn(prompts, max_new_tokens, system)), run=[run] * len(prompts))

    for job in range(jobs):
        mine = todo.filter(F.pmod(F.xxhash64("request"), F.lit(jobs)) == job) if jobs > 1 else todo
        with _small_batches(spark):
            mine.repartition(partitions).mapInArrow(ask, ANSWERS).write.mode("append").parquet(store)
    if not path_exists(spark, store):  # nothing was ever asked
        return df.withColumn(out, F.lit(None).cast("string")).withColumn("run", F.lit(None).cast("string"))
    answers = spark.read.schema(ANSWERS).parquet(store).select(F.col("request").alias("_request"), F.col("answer").alias(out), "run")
    return keyed.join(answers, "_request").drop("_request")


# ---- hosted-service calls ----------------------------------------------------------------

class PermanentError(Exception):
    """An error the service will repeat: not retried."""


def backoff_seconds(attempt: int, base: float = 2.0, cap: float = 60.0, jitter: float = 0.5) -> float:
    """min(cap, base * 2^(attempt-1)) scaled by a factor drawn from 0.7..1.3."""
    return min(cap, base * 2 ** (attempt - 1)) * (0.7 + 0.6 * jitter)


def _ask(make_client, text: str, columns: list, sleep, pause: float, prompt):
    """One request per row: adds ``raw`` and ``call_error`` (null, ``permanent`` or the error's name)."""
    def run(batches):
        client = make_client()
        for rows, texts in _steps(batches, text):
            raws, errors = [], []
            for t, tries in zip(texts, rows.column(rows.schema.get_field_index("attempts")).to_pylist(), strict=True):
                if hasattr(client, "start_row"):  # optional hook of stateful clients
                    client.start_row(int(tries))
                raw, err = None, None
                try:
                    raw = client(prompt(t))
                except PermanentError:
                    err = "permanent"
                except Exception as e:  # noqa: BLE001 - transient by contract
                    err = type(e).__name__
                raws.append(raw)
                errors.append(err)
                sleep(pause)
            yield _with(rows, columns, raw=raws, call_error=errors)
    return run


def call_service(df: DataFrame, make_client, text: str = "text", attempts: int = 5, base: float = 2.0,
                 cap: float = 60.0, pause: float = 0.8, sleep=time.sleep, rand=random.random,
                 user_prefix: str = "", partitions: int | None = None, path: str | None = None,
                 user_suffix: str = "") -> DataFrame:
    """Adds ``raw, attempts, status, error_kind, waited`` per row.

    Rounds of one request per open row.  Each round's answers are written to the shared folder
    and judged by ``validate_api``; rows that failed for a passing reason (any exception but
    ``PermanentError``, or an answer the validator rejects) go to the next round after a jittered
    exponential back-off, once per round and partition.  A permanent error ends the row at once; after ``attempts`` rounds the
    row is an error record.  ``pause`` separates requests; the request rate is
    rows/second x partitions, so ``partitions`` bounds it.
    """
    keep = df.columns
    root = path or scratch_dir(df.sparkSession, "service")
    fields = df.schema.fields
    todo = df.withColumn("attempts", F.lit(0).cast("long")).withColumn("waited", F.lit(0.0))
    done = []
    prompt = lambda t: user_prefix + ("" if t is None else t) + user_suffix
    for a in range(1, attempts + 1):
        schema = T.StructType(fields + [T.StructField("attempts", T.LongType()), T.StructField("waited", T.DoubleType()),
                                        T.StructField("raw", T.StringType()), T.StructField("call_error", T.StringType())])
        d = todo.repartition(partitions) if partitions else todo
        asked = _written(d.mapInArrow(_ask(make_client, text, [*keep, "attempts", "waited"], sleep, pause, prompt), schema),
                         f"{root.rstrip('/')}/round={a}", "service")
        v = V.validate_api(asked, outputs=("ok", "reason")).withColumn("attempts", F.col("attempts") + 1)
        failed = F.coalesce("call_error", "reason")
        v = v.withColumn("_error", F.when(F.col("call_error").isNotNull() | ~F.col("ok"), failed))
        ended = F.col("_error").isNull() | (F.col("_error") == "permanent")
        out = v.withColumn("status", F.when(F.col("_error").isNull(), "ok").otherwise("error"))
        out = _written(out, f"{root.rstrip('/')}/judged={a}", "service")  # the next round and the result read the verdicts
        if a < attempts:
            done.append(out.filter(ended).withColumn("error_kind", F.col("_error")))
            pause_s = backoff_seconds(a, base, cap, rand())
            todo = out.filter(~ended).select(*keep, "attempts", (F.col("waited") + F.lit(pause_s)).alias("waited"))
            if todo.isEmpty():
                break
            sleep(pause_s)
        else:
            last = backoff_seconds(a, base, cap, rand())
            kind = F.when(F.col("_error") == "permanent", "permanent").otherwise(F.concat(F.lit("exhausted:"), F.col("_error")))
            done.append(out.withColumn("error_kind", F.when(F.col("_error").isNotNull(), kind))
                        .withColumn("waited", F.col("waited") + F.when(ended, 0.0).otherwise(F.lit(last))))
    res = None
    for part in done:
        part = part.withColumn("raw", F.when(F.col("status") == "ok", F.col("raw"))) \
            .select(*keep, "raw", "attempts", "status", "error_kind", "waited")
        res = part if res is None else res.unionByName(part)
    return res
