"""The pipeline's stages on the smallest tables, and the registered corpus queries."""

import importlib.util

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shapekit.llm import decontaminate, shingle_join
from tests.conftest import SF_SMALL

NAMES = ["op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op7_", "op8_", "op9_", "op10_"]


def test_registered():
    names = list(entry.queries())
    assert all(sum(n.startswith(p) for n in names) == 1 for p in NAMES) and "pipeline" in names
    assert importlib.util.find_spec("corpus_pipeline")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "a", 0), (10**6 + 1, "77 !!", None, None, 5)], docs.schema)
    docs = docs.unionByName(odd).withColumn("score", F.lit(1)).withColumn("epoch", F.lit("e"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = (docs, out)
        docs = out
    before, after = seen["language_id"]
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == {10**6, 10**6 + 1}
    before, after = seen["near_duplicates"]
    groups = shingle_join.jaccard_components(spark, before).collect()
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in groups} and after.count() == len({r.component_id for r in groups})
    before, after = seen["decontamination"]
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    hit = {r.doc_id for r in decontaminate.contamination(spark, before, bench).where("contaminated").collect()}
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == hit
    before, after = seen["source_mixing"]
    rows = {r.doc_id: r for r in before.collect()}
    copies = after.groupBy("doc_id").count().collect()
    assert all(rows[r.doc_id] == r for r in after.collect()) and max(r["count"] for r in copies) <= 3
    before, after = seen["token_ids"]
    starts = sorted((r.start, r.n_tokens, r.doc_id) for r in after.collect())
    assert len(starts) == before.count() and [d for *_, d in starts] == sorted(d for *_, d in starts)
    assert all(a + n == b for (a, n, _), (b, _, _) in zip(starts, starts[1:], strict=False))


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
