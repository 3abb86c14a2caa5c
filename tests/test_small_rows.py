"""What is moved and written while inputs are built, and tokens cut once, with the rows as before."""

import os

import pytest
from pyspark.sql import functions as F

from shapekit.functions.arrays import attention_mask, mask_prefix, pad_truncate
from shapekit.operators import examples as X
from shapekit.sources import csv as CSV, derived


def test_steps_are_written_out_after_the_lines_are_grouped(spark, tmp_dir):
    lines = [(1, 2, 7, "R"), (1, 1, 8, "N"), (1, 1, 8, None), (1, 1, 8, "A"), (2, None, 7, "A"), (2, None, 7, "N"), (3, 1, 9, "N"), (None, 1, 7, "N")]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.createDataFrame([(7, "red nut"), (8, 'a "big" bolt')], "p_partkey long, p_name string").write.parquet(f"{tmp_dir}/part.parquet")
    spark.createDataFrame([(1, "1-URGENT"), (2, "5-LOW"), (3, "5-LOW")], "o_orderkey long, o_orderpriority string").write.parquet(f"{tmp_dir}/orders.parquet")
    items = derived.gold_items(spark, tmp_dir)
    assert "step" not in items.schema["items"].dataType.elementType.names
    got = {r.id: (r.ingredients, r.directions) for r in derived.structured_rows(spark, tmp_dir).collect()}
    assert got == {1: ('["a \\"big\\" bolt","a \\"big\\" bolt","a \\"big\\" bolt","red nut"]',
                       '[null,"Pack line 1 flag A","Pack line 1 flag N","Pack line 2 flag R"]'),
                   2: ('["red nut","red nut"]', "[null,null]"), 3: ("[]", "[]")}


def test_derived_lines_are_written_compressed(spark, tmp_dir):
    lines = spark.range(20_000).select(F.concat(F.col("id").cast("string"), F.lit(',"some title that repeats","[]","[]"')).alias("line"))
    path = derived.write_csv_lines(lines.coalesce(2), f"{tmp_dir}/csv", derived.STRUCT_HEADER)
    good, _ = CSV.read_tolerant_csv(spark, path, ["id", "title", "ingredients", "directions"])
    assert good.select(F.count("*"), F.countDistinct("id"), F.countDistinct("title")).first() == (20_000, 20_000, 1)
    assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.startswith("part-")) < 20_000 * 20


@pytest.mark.parametrize("max_len", [1, 7, 40])
def test_examples_are_as_when_prompt_and_full_text_are_cut_apart(spark, max_len):
    rows = [("a b\n", "a b\nc, d é😀"), ("a b", "a bc d"), ("zz\n", "other text"), ("", ""), ("\n", "\n"), ("x\n", "x\n"), (None, "q r"),
            ("p\n", None), ("é😀 k_1!\n", "é😀 k_1!\n" + "w " * 50)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, prompt string, full string")
    got = X.tokenize_examples(d, max_len)
    ids, n, m = X.word_ids("full"), F.size(X.word_tokens("prompt")), F.size(X.word_ids("full"))
    want = d.select(*d.columns, n.alias("prefix_len"), m.alias("full_len"), pad_truncate(ids, max_len, X.PAD_ID).alias("input_ids"),
                    attention_mask(ids, max_len).alias("attention_mask"))
    want = want.withColumn("labels", mask_prefix("input_ids", "prefix_len", max_len, False, F.least("full_len", F.lit(max_len))))
    assert got.columns == want.columns
    assert got.orderBy("id").collect() == want.orderBy("id").collect()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(cast(lambda" in plan and "slice(" in plan.split("md5(cast(lambda")[0].rsplit("transform(", 1)[1]


def test_list_cells_of_rows_without_a_text_are_not_parsed(spark):
    from shapekit.plans import catalog
    plan = catalog._example_inputs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" in plan.split("Join Inner")[0].lower() and "regexp" not in plan.split("Join Inner", 1)[1].lower()
