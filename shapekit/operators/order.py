"""Positions, head/tail, reproducible splits, leak checks and length buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shapekit.functions.text import normalise_title
from shapekit.session import scratch_dir

_PID_SHIFT = 33  # monotonically_increasing_id keeps the partition id above bit 33


def index_rows(df: DataFrame, order_cols, name: str = "pos", partitions: int | None = None) -> DataFrame:
    """0-based position by ``order_cols`` (must be unique) without a global window.

    The rows are range-partitioned, sorted and written once to the shared folder
    with their partition and place in it.  Counts per partition (one row each) and
    the rows themselves are both read from that one table: a second range shuffle would
    sample bounds of its own, and its partitions would not be the same.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in
            (order_cols if isinstance(order_cols, (list, tuple)) else [order_cols])]
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    s = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).withColumn("_mid", mid)
         .withColumn("_pid", F.shiftright("_mid", _PID_SHIFT))
         .withColumn("_rip", F.col("_mid") - F.shiftleft(F.col("_pid"), _PID_SHIFT)).drop("_mid"))
    path = scratch_dir(spark, "positions")
    s.write.parquet(path)
    s = spark.read.schema(s.schema).parquet(path)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (s.join(offsets, "_pid", "inner")
             .withColumn(name, (F.col("_off") + F.col("_rip")).cast("bigint"))
             .drop("_pid", "_rip", "_off"))


def head_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows by key (top-k per partition, then one merge)."""
    return df.orderBy(F.col(key).asc()).limit(n)


def tail_n(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(F.col(key).desc()).limit(n)


def eval_set(head: DataFrame, tail: DataFrame) -> DataFrame:
    """Baseline rows followed by held-out rows, tagged by ``part``."""
    return (head.withColumn("part", F.lit("head"))
            .unionByName(tail.withColumn("part", F.lit("tail"))))


def split_key(id_col, seed: int) -> F.Column:
    """Reproducible per-row hash; independent of partitioning and read order."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(c.cast("string"), F.lit(str(seed))))


def split_rows(df: DataFrame, id_col: str = "id", test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """``df`` with ``split``: exactly ceil(test_size * n) rows are ``test``, the first by hash.

    Rows fall into 65,536 buckets by the first four digits of their hash.  Counts per bucket and
    their running sum give the bucket in which test ends; lower buckets are test and
    higher ones train without any shuffle of the rows, and only that one bucket
    is ranked.  Everything is a function of the ids, so two evaluations agree.
    """
    d = df.withColumn("_h", split_key(id_col, seed)).withColumn("_b", F.substring("_h", 1, 4))
    n_test = F.ceil(F.lit(float(test_size)) * F.sum("_n").over(Window.partitionBy()))
    before = F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")
    # at most 65,536 rows of a few bytes
    counts = F.broadcast(d.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
                         .select("_b", (n_test - before).alias("_room"), "_n"))
    d = d.join(counts, "_b")
    whole = d.filter((F.col("_room") <= 0) | (F.col("_room") >= F.col("_n"))) \
        .withColumn("split", F.when(F.col("_room") > 0, "test").otherwise("train"))
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_h", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))
    cut = d.filter((F.col("_room") > 0) & (F.col("_room") < F.col("_n"))) \
        .withColumn("split", F.when(place <= F.col("_room"), "test").otherwise("train"))
    return whole.unionByName(cut).select(*[F.col(f"`{c}`") for c in df.columns], "split")


def train_test_split(df: DataFrame, id_col: str = "id", test_size: float = 0.1, seed: int = 42):
    """(train, test) of ``split_rows``."""
    tagged = split_rows(df, id_col, test_size, seed)
    return tagged.filter(F.col("split") == "train"), tagged.filter(F.col("split") == "test")


def hash_split(df: DataFrame, id_col: str = "id", test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """Scale variant: test iff the hash falls under the share (about test_size, no count)."""
    h = F.conv(F.substring(split_key(id_col, seed), 1, 8), 16, 10).cast("double") / float(16 ** 8)
    return df.withColumn("split", F.when(h < test_size, "test").otherwise("train"))


def text_key(c) -> F.Column:
    """md5 of the normalised text (case, quotes, white space folded)."""
    return F.md5(normalise_title(c))


def leak_check(train: DataFrame, evals: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(kind, key, n_train, n_eval) for ids and normalised texts present on both sides.

    Aggregates per key on each side before the join, so a text repeated many
    times costs one row per side, never the pairs.
    """
    def side(df, label):
        ids = df.groupBy(F.col(id_col).cast("string").alias("key")).agg(F.count(F.lit(1)).alias(label))
        txt = df.groupBy(text_key(F.col(text_col)).alias("key")).agg(F.count(F.lit(1)).alias(label))
        return ids.withColumn("kind", F.lit("id")).unionByName(txt.withColumn("kind", F.lit("text")))
    return side(train, "n_train").join(side(evals, "n_eval"), ["kind", "key"], "inner")


def split_leaks(df: DataFrame, id_col: str = "id", text_col: str = "text", test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """``leak_check`` of a split table: texts are folded to their keys before the split, so no text moves,
    and ids and keys of both sides are counted in one aggregation."""
    d = split_rows(df.select(F.col(id_col), text_key(F.col(text_col)).alias("_key")), id_col, test_size, seed)
    each = F.explode(F.array(F.struct(F.lit("id").alias("kind"), F.col(id_col).cast("string").alias("key")),
                             F.struct(F.lit("text").alias("kind"), F.col("_key").alias("key")))).alias("k")
    return (d.select(each, "split").groupBy("k.kind", "k.key")
            .agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_eval"))
            .filter((F.col("n_train") > 0) & (F.col("n_eval") > 0)))


def length_buckets(df: DataFrame, length_col: str, width: int, partitions: int | None = None) -> DataFrame:
    """Rows of similar length together: range-partition and sort by length, bucket id added.

    The range key is (length, row hash): rows sharing one length value can
    still spread over several partitions, so a dominant length is no hot spot.
    """
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return (df.repartitionByRange(n, F.col(length_col), tie).sortWithinPartitions(length_col)
            .withColumn("bucket", F.floor(F.col(length_col) / width).cast("bigint")))


def rank_improvement(rates: DataFrame, base: str = "base_rate", gain: str = "gain") -> DataFrame:
    """Rank models by base rate and by gain (input: one row per model, small)."""
    return (rates.withColumn("rank_base", F.rank().over(Window.orderBy(F.col(base).desc())))
                 .withColumn("rank_gain", F.rank().over(Window.orderBy(F.col(gain).desc()))))
