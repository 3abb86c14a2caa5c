"""Padding/masking edge lengths, positions, splits, leak check."""

from pyspark.sql import functions as F

from shapekit.functions.arrays import attention_mask, mask_prefix, pad_truncate, token_budget
from shapekit.operators import order as O


def test_pad_truncate_mask(spark):
    L = 4
    rows = [([], 0), ([7, 8, 9], 1), ([7, 8, 9, 10], 2), ([7, 8, 9, 10, 11], 9)]
    df = spark.createDataFrame(rows, "ids array<int>, pre int")
    out = df.select(pad_truncate("ids", L, 0).alias("p"), attention_mask("ids", L).alias("m"),
                    mask_prefix(pad_truncate("ids", L, 0), "pre", L).alias("lab"),
                    mask_prefix(pad_truncate("ids", L, 0), "pre", L, True, F.least(F.size("ids"), F.lit(L))).alias("lp"),
                    token_budget(F.col("pre") * 1000, 4096).alias("b")).collect()
    assert [r.p for r in out] == [[0, 0, 0, 0], [7, 8, 9, 0], [7, 8, 9, 10], [7, 8, 9, 10]]
    assert [r.m for r in out] == [[0, 0, 0, 0], [1, 1, 1, 0], [1, 1, 1, 1], [1, 1, 1, 1]]
    assert [r.lab for r in out] == [[0, 0, 0, 0], [-100, 8, 9, 0], [-100, -100, 9, 10], [-100] * 4]
    assert out[1].lp == [-100, 8, 9, -100]
    assert [r.b for r in out] == [1200, 1200, 1200, 256]


def test_index_rows_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=13).select((F.col("id") * 7919 % 5000).alias("k"))
    out = O.index_rows(df, ["k"], "pos").collect()
    assert sorted((r.pos, r.k) for r in out) == [(i, i) for i in range(5000)]


def test_split_exact_and_reproducible(spark):
    df = spark.range(0, 1001).withColumnRenamed("id", "doc_id")
    tr, te = O.train_test_split(df, "doc_id", 0.1, 42)
    ids = sorted(r.doc_id for r in te.collect())
    assert len(ids) == 101 and tr.count() == 900
    tr2, te2 = O.train_test_split(df.repartition(7), "doc_id", 0.1, 42)
    assert sorted(r.doc_id for r in te2.collect()) == ids


def test_leak_check_aggregates(spark):
    a = spark.createDataFrame([(1, "Same Text"), (2, "same  text"), (3, "other")], "id long, text string")
    b = spark.createDataFrame([(3, "x"), (9, "SAME TEXT")], "id long, text string")
    rows = {(r.kind, r.n_train, r.n_eval) for r in O.leak_check(a, b).collect()}
    assert rows == {("id", 1, 1), ("text", 2, 1)}


def test_user_tokenizer_udf(spark):
    from shapekit.operators.examples import tokenizer_udf, word_ids

    def make():
        return lambda s: [len(w) for w in s.split()]
    df = spark.createDataFrame([("ab c def",), (None,)], "t string")
    out = df.select(tokenizer_udf(make)("t").alias("ids"), word_ids(F.col("t")).alias("w")).collect()
    assert out[0].ids == [2, 1, 3] and out[1].ids is None and len(out[0].w) == 3


def test_require_nonempty(spark):
    import pytest
    from shapekit.operators.pairs import EmptyInputError, require_nonempty
    with pytest.raises(EmptyInputError):
        require_nonempty(spark.createDataFrame([], "t string"))
    r = require_nonempty(spark.createDataFrame([(" ",), ("a",)], "t string"), "t").collect()
    assert [x.blank for x in r] == [True, False]


def test_length_buckets_spread_a_dominant_length(spark):
    df = spark.range(0, 4000).select("id", F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id")).alias("n"))
    b = O.length_buckets(df, "n", 50, partitions=8)
    sizes = b.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 4000 / 3
    assert b.filter("bucket = 2").count() == df.filter("n >= 100 and n < 150").count()


def test_index_rows_wide_rows_and_filters(spark):
    # a wide column makes the main branch's shuffle much larger than the
    # key-only counts branch; positions must still line up
    df = spark.range(0, 20000, numPartitions=8).select(
        "id", F.repeat(F.lit("x"), 2000).alias("pad"))
    tr, te = O.train_test_split(df, "id", 0.1, 42)
    picked = [3, 17, 9999, 12345, 19999]
    a = {r.id for r in tr.filter(F.col("id").isin(picked)).collect()}
    b = {r.id for r in te.filter(F.col("id").isin(picked)).collect()}
    assert a | b == set(picked) and not (a & b)
    pos = O.index_rows(df, ["id"], "pos").filter(F.col("id").isin(picked)).collect()
    assert sorted((r.id, r.pos) for r in pos) == [(i, i) for i in picked]


def test_fast_word_ids(spark):
    from shapekit.operators.examples import N_SPECIAL, VOCAB, word_ids
    r = spark.createDataFrame([("a b, c",)], "t string").select(
        word_ids(F.col("t")).alias("m"), word_ids(F.col("t"), hash_fn="xxhash64").alias("x")).first()
    assert len(r.m) == len(r.x) == 4 and all(N_SPECIAL <= i < VOCAB for i in r.x)
