"""The chunk assembler's requests share state entries by shard; answers are made once and cut once."""

from pyspark.sql import functions as F

from shapekit.streaming import assemble as ST2

START = 1_704_067_200
SCHEMA = "idx long, seq int, chunk string, is_last boolean, ts timestamp"


def _run(spark, at, name, rows, shards):
    """Rows (idx, seq, chunk, is_last, second) as one more file, and the stream over all files; the state's rows by batch."""
    (spark.createDataFrame(rows, "idx long, seq int, chunk string, is_last boolean, s long").coalesce(1)
     .withColumn("ts", F.timestamp_seconds(F.lit(START) + F.col("s"))).drop("s").write.parquet(f"{at}/src/{name}"))
    q = (ST2.assemble_stream(spark.readStream.schema(SCHEMA).parquet(f"{at}/src/*"), shards=shards).writeStream
         .format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]


def _ended(spark, at):
    return sorted(tuple(r) for r in spark.read.schema(ST2.OUTPUT_SCHEMA).parquet(f"{at}/out").collect())


def test_requests_share_state_entries(spark, tmp_dir):
    ids = list(range(40)) + [2**62 + 1]
    first = [(i, 0, f'x {{"id":"{i} }} \\', False, 0) for i in ids if i != 7]
    rest = [(i, 1, '"",', False, 1) for i in ids] + [(i, 2, '"l":{}} y', i % 2 == 0, 2) for i in ids]
    # the second run brings request 7 last chunk first, and everything a second time
    rest = [*reversed(rest), *rest, (7, 0, f'x {{"id":"{7} }} \\', False, 2)]
    n = _run(spark, tmp_dir, "a", first, 3) + _run(spark, tmp_dir, "b", rest, 3)
    assert 0 < max(n) <= 3
    assert _ended(spark, tmp_dir) == [(i, f'{{"id":"{i} }} \\"","l":{{}}}}', "complete", None) for i in ids]


def test_requests_of_a_shard_time_out_each(spark, tmp_dir):
    _run(spark, tmp_dir, "a", [(1, 0, '{"a":', False, 0), (2, 0, '{"b":', False, 0), (3, 0, "{}", True, 0),
                               (4, 0, "no", True, 0), (5, 0, "{", True, 0)], 1)
    assert _ended(spark, tmp_dir) == [(3, "{}", "complete", None), (4, None, "no_json", "no_brace"), (5, None, "no_json", "unclosed")]
    # the watermark goes to 70: request 1 has been silent past 60, request 2 has until 110; 3 ended and stays so
    _run(spark, tmp_dir, "b", [(2, 1, "[", False, 50), (3, 1, "{}", True, 60), (6, 0, "{", False, 130)], 1)
    assert [r for r in _ended(spark, tmp_dir) if r[0] in (1, 2, 3, 6)] == [(1, None, "no_json", "timeout"), (3, "{}", "complete", None)]
    _run(spark, tmp_dir, "c", [(2, 2, "]}", True, 100), (6, 1, "}", True, 131)], 1)
    assert [r for r in _ended(spark, tmp_dir) if r[0] in (1, 2, 6)] == [
        (1, None, "no_json", "timeout"), (2, '{"b":[]}', "complete", None), (6, "{}", "complete", None)]


def test_shards_grow_with_requests():
    assert [ST2.shards_for(n) for n in (0, 1, 1000, 1001, 3_000_000)] == [1, 1, 10, 11, 30_000]


def test_answers_are_made_and_cut_once(spark):
    long = "a\U0001f600\nb" * 3
    df = spark.createDataFrame([(1, long), (2, ""), (3, None), (4, "abcd"), (5, "abcde")], "idx long, t string")
    chunks = ST2.chunk_answers(df.select("idx", F.reverse("t").alias("raw")), size=4)
    got = sorted((r.idx, r.seq, r.chunk, r.is_last, r.ts.second) for r in chunks.collect())
    back = long[::-1]
    assert got == [(1, 0, back[:4], False, 0), (1, 1, back[4:8], False, 1), (1, 2, back[8:], True, 2), (2, 0, "", True, 0),
                   (4, 0, "dcba", True, 0), (5, 0, "edcb", False, 0), (5, 1, "a", True, 1)]
    plan = chunks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reverse(") == 1 and plan.count("regexp_extract_all(") == 1
