"""Scoring in steps: no call of a model, and no batch a task gives back, grows with the Arrow batch."""

import pyarrow as pa

from shapekit.operators import score as SC
from shapekit.plans import stubs


def _batch(texts):
    return pa.RecordBatch.from_pydict({"idx": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def test_steps_are_bounded_by_rows_and_bytes():
    texts = ["a"] * 600 + [None, "x" * (3 * SC.STEP_BYTES), ""] + ["é" * 3000] * 700
    steps = list(SC._steps([_batch(texts), _batch([])], "text"))
    assert [t for _, s in steps for t in s] == texts
    assert [i for rows, _ in steps for i in rows.column(0).to_pylist()] == list(range(len(texts)))
    for _, s in steps:
        assert len(s) <= SC.STEP_ROWS
        assert len(s) == 1 or sum(len((t or "").encode()) for t in s) <= SC.STEP_BYTES


def test_a_model_never_sees_a_whole_batch(spark):
    def make_model():
        return lambda prompts, n, system: [f"{len(prompts)}"] * len(prompts)
    df = spark.range(3000).selectExpr("id AS idx", "CAST(id AS STRING) AS text").coalesce(1)
    seen = SC.score(df, make_model)
    assert seen.count() == 3000
    assert max(int(r.raw) for r in seen.select("raw").distinct().collect()) <= SC.STEP_ROWS
    requests = SC.score_requests(df, make_model, SC.scratch_dir(spark, "steps"), partitions=1, chunk_rows=3000)
    assert requests.count() == 3000
    assert max(int(r.raw) for r in requests.select("raw").distinct().collect()) <= SC.STEP_ROWS


def test_service_gives_rows_back_in_steps_and_keeps_null_keys(spark):
    rows = [(None if i % 7 == 3 else (1 << 60) + i, None if i % 11 == 5 else "t" * (i % 40)) for i in range(1500)]
    out = SC.call_service(spark.createDataFrame(rows, "idx long, text string"), stubs.make_flaky_service,
                          sleep=lambda s: None, rand=lambda: 0.5, pause=0.0).collect()
    assert sorted((r.idx is None, r.idx or 0, r.text or "") for r in out) == sorted((a is None, a or 0, b or "") for a, b in rows)
    batches = list(SC._ask(stubs.make_flaky_service, "text", ["idx"], lambda s: None, 0.0, lambda t: t or "")(
        [_batch(["t"] * 1000).append_column("attempts", pa.array([0] * 1000, pa.int64()))]))
    assert sum(b.num_rows for b in batches) == 1000 and max(b.num_rows for b in batches) <= SC.STEP_ROWS
