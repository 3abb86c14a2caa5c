"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sizes are words per document.  Every source gets a target: its weight's share of
all words, held at three times the source's own size, the excess going to the
other sources by weight.  The mix then

1. deals the documents of a source over permuted blocks by hash, of about equal
   words; the number of blocks over all sources is bounded by a parameter, so blocks
   grow with the corpus and the tree does not;
2. fixes each source's exact block quota: all blocks once per whole epoch, and a
   prefix of the permuted blocks for the rest, the last block cut between documents;
3. splits the quotas of all sources among the output shards down a binary tree: at each
   node the left half's share of the node's blocks is drawn without replacement
   (multivariate hypergeometric, source after source), the right half has the remainder;
4. gives each shard the next blocks of every source's permuted order, disjoint by
   construction, and orders documents inside a shard by hash.

All draws are hashes of (seed, place), so reruns agree.  Text is read once, to
count words; everything later works on (doc_id, source, size) rows in the shared folder.
Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
SHARDS = 16
BLOCKS_PER_SHARD = 64
SEED = 17


def word_count(text: Column) -> Column:
    """Words of a text (null: 0), long."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _unit(*parts: Column) -> Column:
    """Uniform in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, total, target)``: one row per source, null included.

    Weights repeat over the sources by code point, null last.  Water filling: with
    sources ordered by cap/weight, a common level holds for all that do not reach their cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("long"))
         .withColumn("cap", F.col("source_size") * cap))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = (s.withColumn("total", F.sum("source_size").over(everything))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(upto), F.lit(0))) / F.sum("w").over(rest))
         .withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)["level"]))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("w"), F.col("cap").cast("double")))
    return s.select("source", "source_size", "total", target.alias("target"))


def _left_draw(n_left: Column, n_all: Column, k: Column, *place: Column) -> Column:
    """Hypergeometric draw: of ``k`` marked among ``n_all`` blocks, how many are among
    the ``n_left`` that go left.  An urn, block after block; counts are bounded by
    the tree's block bound."""
    step = F.aggregate(
        F.sequence(F.lit(1), k),
        F.struct(F.lit(0).cast("long").alias("x"), n_left.cast("long").alias("l"), n_all.cast("long").alias("n")),
        lambda a, i: F.when(_unit(F.lit(SEED), *place, i) * a["n"] < a["l"],
                            F.struct((a["x"] + 1).alias("x"), (a["l"] - 1).alias("l"), (a["n"] - 1).alias("n")))
        .otherwise(F.struct(a["x"].alias("x"), a["l"].alias("l"), (a["n"] - 1).alias("n"))),
        lambda a: a["x"])
    return F.when((k <= 0) | (n_all <= 0), F.lit(0).cast("long")).otherwise(step)


def splitting_tree(quotas: DataFrame, shards: int) -> DataFrame:
    """``quotas(source, quota)`` -> ``(source, shard, blocks)``; each source's blocks sum to its quota.

    Shards of one level hold equal numbers of blocks (to one).  Level by level, a
    node's sources are one array in a row, drawn one after another.
    """
    node = (quotas.agg(F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("no"), "source", "quota"))).alias("q"))
            .select(F.lit(0).alias("node"), F.transform("q", lambda s: F.struct(s["source"].alias("source"), s["quota"].alias("k"))).alias("q")))
    for level in range(max(0, math.ceil(math.log2(shards)))):
        n = F.aggregate("q", F.lit(0).cast("long"), lambda a, s: a + s["k"])
        node = node.withColumn("n", n).withColumn("half", F.floor((F.col("n") + 1) / 2).cast("long"))

        lev = F.lit(level)

        def draw(a, s):
            x = _left_draw(a["l"], a["n"], s["k"], lev, F.col("node"), F.coalesce(s["source"], F.lit("")), s["source"].isNull())
            return F.struct((a["l"] - x).alias("l"), (a["n"] - s["k"]).alias("n"), F.concat(a["xs"], F.array(x)).alias("xs"))

        drawn = F.aggregate("q", F.struct(F.col("half").alias("l"), F.col("n").alias("n"), F.array().cast("array<bigint>").alias("xs")),
                            draw, lambda a: a["xs"])
        left = F.zip_with("q", "xs", lambda s, x: F.struct(s["source"].alias("source"), x.alias("k")))
        right = F.zip_with("q", "xs", lambda s, x: F.struct(s["source"].alias("source"), (s["k"] - x).alias("k")))
        node = (node.withColumn("xs", drawn)
                .select(F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), left.alias("q")),
                                          F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("q")))).alias("h"))
                .select("h.node", "h.q"))
    return (node.select(F.col("node").alias("shard"), F.explode("q").alias("s"))
            .select(F.col("s.source").alias("source"), "shard", F.col("s.k").alias("blocks")))


def mix(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD,
        weights: tuple[int, ...] = (1, 2, 3)) -> tuple[DataFrame, DataFrame]:
    """Plan of the mix: ``(draws, sized)``.

    ``draws(doc_id, source, size, words, epoch, shard, place)`` has one row per document copy
    taken (``words`` of it: all, but for the last document of a source); sorting a shard by
    ``place`` is its local shuffle.  ``sized(doc_id, source, size,
    source_size, target)`` has one row per document.  ``shards`` is a power of two.

    A null source is a source of its own.  Null or empty texts have size 0 and add nothing.
    Rows that repeat a doc_id are dealt together and each row is drawn.  No words at all: no draws.
    Columns other than doc_id, text and source are ignored.
    """
    C.prepare(spark)
    base = C.store(spark, sizes(docs), "mix-sizes")
    targets = C.store(spark, source_targets(base, weights).coalesce(1), "mix-targets")
    slots = shards * blocks_per_shard
    plan = (targets
            .withColumn("nb", F.greatest(F.lit(1), F.ceil(F.col("source_size") * slots / F.greatest("total", F.lit(1)))).cast("long"))
            .withColumn("epochs", F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long"))
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
            .select("source", "source_size", "target", "nb", "epochs", "rest"))
    plan = C.store(spark, plan, "mix-plan")
    dealt = (base.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
             .select("d.doc_id", "d.source", "d.size", F.pmod(F.xxhash64(F.lit(SEED), F.col("d.doc_id")), F.col("p.nb")).alias("block")))
    # one row per block: words, and the place in the permuted order of its source
    src = [F.col("source").isNull(), F.col("source")]
    order = Window.partitionBy(*src).orderBy(F.xxhash64(F.lit(SEED + 1), F.col("block")), "block")
    blocks = (dealt.where("size > 0").groupBy("source", "block").agg(F.sum("size").alias("words"))
              .withColumn("rank", F.row_number().over(order)).withColumn("after", F.sum("words").over(order)))
    blocks = C.store(spark, blocks, "mix-blocks")
    b = (blocks.alias("b").join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
         .select("b.source", "b.block", "b.rank", "b.words", "b.after", "p.epochs", "p.rest"))
    n_blocks = F.count("*").over(Window.partitionBy(*src))
    whole = (b.withColumn("n", n_blocks).where("epochs > 0")
             .select("source", "block", "rank", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("epochs"))).alias("epoch"), F.lit(None).cast("double").alias("room")))
    part = (b.withColumn("n", n_blocks).where("after - words < rest")
            .select("source", "block", "rank", "n", (F.col("epochs") + 1).alias("epoch"),
                    F.when(F.col("after") > F.col("rest"), F.col("rest") - (F.col("after") - F.col("words"))).alias("room")))
    drawn = whole.unionByName(part).withColumn("turn", (F.col("epoch") - 1) * F.col("n") + F.col("rank"))
    tree = splitting_tree(drawn.groupBy("source").agg(F.count("*").alias("quota")), shards)
    upto = Window.partitionBy(*src).orderBy("shard")
    cuts = (tree.withColumn("last", F.sum("blocks").over(upto)).withColumn("first", F.col("last") - F.col("blocks")).where("blocks > 0"))
    cuts = C.store(spark, cuts.coalesce(1), "mix-tree")
    placed = (drawn.alias("a").join(cuts.alias("c"), F.col("a.source").eqNullSafe(F.col("c.source")) & (F.col("a.turn") > F.col("c.first")) & (F.col("a.turn") <= F.col("c.last")))
              .select("a.source", "a.block", "a.epoch", "a.room", "c.shard"))
    placed = C.store(spark, placed, "mix-draws")
    # documents of the drawn blocks; a cut block gives its documents in hash order, the last one in part
    rows = (dealt.alias("d").where("d.size > 0")
            .join(placed.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source")) & (F.col("d.block") == F.col("q.block")))
            .select("d.doc_id", "d.source", "d.size", "d.block", "q.epoch", "q.room", "q.shard"))
    inside = Window.partitionBy(*src, "block", "epoch").orderBy(F.xxhash64(F.lit(SEED + 2), F.col("doc_id")), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    cut = (rows.where("room is not null").withColumn("before", F.sum("size").over(inside) - F.col("size"))
           .withColumn("words", F.least(F.col("size"), F.floor(F.col("room") - F.col("before"))).cast("long")).where("words > 0").drop("before"))
    draws = (rows.where("room is null").withColumn("words", F.col("size")).unionByName(cut)
             .select("doc_id", "source", "size", "words", "epoch", "shard", F.xxhash64(F.lit(SEED + 3), F.col("epoch"), F.col("doc_id")).alias("place")))
    sized = (base.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
             .select("d.doc_id", "d.source", "d.size", "t.source_size", "t.target"))
    return draws, sized


def mix_summary(spark: SparkSession, docs: DataFrame, **kw) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``: words the mix takes of each document."""
    draws, sized = mix(spark, docs, **kw)
    # repeated rows of one doc_id are drawn alike: the mean over them
    taken = (draws.groupBy("doc_id", "source", "size", "epoch").agg(F.avg("words").alias("words"))
             .groupBy("doc_id", "source", "size").agg(F.sum("words").alias("taken")))
    return (sized.alias("d").join(taken.alias("k"), (F.col("d.doc_id") == F.col("k.doc_id")) & F.col("d.source").eqNullSafe(F.col("k.source")) & (F.col("d.size") == F.col("k.size")), "left")
            .select("d.doc_id", "d.size", "d.source_size", "d.target", F.coalesce("k.taken", F.lit(0)).cast("long").alias("taken")))


#: words of one output file; a shard with more has several
FILE_WORDS = 10_000_000


def mixed_documents(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, **kw) -> DataFrame:
    """The mix as rows of ``docs``, one per copy taken, all columns unchanged; shard by shard, shuffled inside.
    A large shard is dealt over files by the shuffled place, so no task holds more than about ``FILE_WORDS``.
    A source's last document is taken whole if at least half of it is wanted.  Documents without words are not taken."""
    draws, sized = mix(spark, docs, shards=shards, **kw)
    words = sized.agg(F.sum("size")).first()[0] or 0
    files = max(1, -(-words // (shards * FILE_WORDS)))
    d = draws.where("2 * words >= size").select("doc_id", "source", "epoch", "shard", "place").distinct().alias("m")
    rows = docs.alias("d").join(d, F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("d.source").eqNullSafe(F.col("m.source")))
    part = (F.col("m.shard") * files + F.pmod(F.col("m.place"), F.lit(files))).cast("int")
    return (rows.select(F.struct("d.*").alias("row"), part.alias("part"), F.col("m.place").alias("place"))
            .repartitionById(shards * files, "part").sortWithinPartitions("place").select("row.*"))
