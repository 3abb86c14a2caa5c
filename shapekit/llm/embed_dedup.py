"""Embedding near-dedup: spherical k-means cells and blocked cosine products.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors); every vector is then
assigned.  A vector belongs to the cell of its nearest centroid and also visits each
cell whose border it is near: vectors of cosine >= 0.95 are at most a chord of
sqrt(0.1) apart, so of two in different cells one at least lies within half the chord of the
plane between the two centroids.  That is the margin, and a pair is found if either end visits
the other's cell: no pair is lost in any dimension.

Cells are compared in blocks of bounded size, home rows against visitors, as
matrix products in double precision; a cell of any size is only more blocks.  Vectors
with equal components are one row with a count.  A linked pair is counted in one cell.
Each block returns per vector its links and the smallest vector it reaches in the
block, so rows out grow with vectors, not pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .graph import components

COSINE = 0.95
SAMPLE = 20_000
MAX_CELLS = 2048
BLOCK = 1024
ROUNDS = 8


def unit(col: pa.Array) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision (all of one length)."""
    n = len(col)
    x = np.asarray(col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)).reshape(n, -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means centroids; starts are spread over the sample, empty cells keep their place."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(1)
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        size = np.sqrt((s * s).sum(1))
        c = np.where(size[:, None] > 1e-9, s / np.maximum(size, 1e-9)[:, None], c)
    return np.unique(c, axis=0)


class Cells:
    """Centroids by vector length; cells are numbered over all lengths."""

    def __init__(self, by_dim: dict[int, np.ndarray], cosine: float):
        self.by_dim, self.base, at = by_dim, {}, 0
        chord = float(np.sqrt(2 - 2 * cosine))
        self.margin = {d: chord / 2 + 1e-9 for d in by_dim}  # and what rounding may add
        for d in sorted(by_dim):
            self.base[d] = at
            at += len(by_dim[d])
        self.apart = {d: np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T))) for d, c in by_dim.items()}


def _assign(held):
    def run(batches):
        cells = held.value
        for batch in batches:
            emb = C.column(batch, "embedding")
            dims = emb.value_lengths().to_numpy()
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                x = unit(emb.take(pa.array(rows)))
                c, base, margin, apart = cells.by_dim[d], cells.base[d], cells.margin[d], cells.apart[d]
                near = x @ c.T
                home = near.argmax(1)
                gap = near[np.arange(len(x)), home][:, None] - near
                visit = gap <= margin * apart[home]
                visit[np.arange(len(x)), home] = True
                who, where = np.nonzero(visit)
                yield pa.RecordBatch.from_arrays([
                    C.column(batch, "vec_id").take(pa.array(rows)), C.column(batch, "copies").take(pa.array(rows)),
                    emb.take(pa.array(rows)), pa.array(home + base, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(who, np.arange(len(x) + 1)), pa.int32()), pa.array(where + base, pa.int32())),
                ], names=["vec_id", "copies", "embedding", "home", "visits"])
    return run


def _compare(cosine: float):
    def run(key, t):
        t = t.combine_chunks()
        at_home = t["is_home"].to_numpy()
        x, y = t.filter(pa.array(at_home)), t.filter(pa.array(~at_home))
        cols = {"vec_id": [], "links": [], "hub": []}
        if x.num_rows and y.num_rows:
            cell = key[0].as_py()
            ux, uy = (unit(s["embedding"].combine_chunks()) for s in (x, y))
            xi, yi = (s["vec_id"].to_numpy() for s in (x, y))
            xn, yn = (s["copies"].to_numpy() for s in (x, y))
            i, j = np.nonzero(ux @ uy.T >= cosine)
            # each pair in one cell: that of the smaller id if the larger visits it, else that of the larger
            here = xi[i] < yi[j]
            other = y["home"].to_numpy()[j] != cell
            width = 1 << 32
            v = x["visits"].combine_chunks()
            seen = np.repeat(np.arange(len(xi)), v.value_lengths().to_numpy()) * width + v.flatten().to_numpy()
            ask = i * width + y["home"].to_numpy()[j]
            keep = here | other & (xi[i] > yi[j]) & ~np.isin(ask, seen)
            i, j = i[keep], j[keep]
            ids, at = np.unique(np.concatenate((xi, yi)), return_inverse=True)
            a, b = at[:len(xi)][i], at[len(xi):][j]
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, a, yn[j])
            np.add.at(links, b, xn[i])
            label = np.arange(len(ids))
            while len(a):
                low = np.minimum(label[a], label[b])
                new = label.copy()
                np.minimum.at(new, a, low)
                np.minimum.at(new, b, low)
                new = new[new]
                if (new == label).all():
                    break
                label = new
            some = links > 0
            cols = {"vec_id": ids[some], "links": links[some], "hub": ids[label[some]]}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in cols.items()})
    return run


def vector_groups(spark: SparkSession, vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding)``.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing and are kept.  Vectors of different lengths are not compared.  A component's
    smallest vec_id is its representative, the one kept.  Repeated rows count as
    separate vectors.  Empty input: empty result.  Other columns, labels included, are ignored.
    """
    C.prepare(spark)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    reps = base.where(valid).groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    reps = C.store(spark, reps, "vectors-distinct")
    n = reps.count()
    pick = reps.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < min(1 << 20, max(1, (sample << 20) // max(n, 1))))
    seen = pick.select("vec_id", "embedding").toArrow().sort_by("vec_id")["embedding"].combine_chunks()
    dims = [r[0] for r in reps.select(F.size("embedding")).distinct().collect()]
    length = seen.value_lengths().to_numpy() if len(seen) else np.zeros(0)
    k = int(min(MAX_CELLS, max(1, np.sqrt(n) / 2)))
    by_dim = {}
    for d in dims:
        rows = np.flatnonzero(length == d)  # a length the sample misses has one cell
        by_dim[d] = fit(unit(seen.take(pa.array(rows))), k) if len(rows) else np.eye(1, d)
    held = spark.sparkContext.broadcast(Cells(by_dim, cosine))
    schema = f"vec_id long, copies long, embedding {dict(reps.dtypes)['embedding']}, home int, visits array<int>"
    placed = C.store(spark, reps.mapInArrow(_assign(held), schema), "vectors-cells")
    # blocks of each cell; one row per cell
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(c / block)).cast("int")
    visits = placed.select(F.explode("visits").alias("cell"), F.col("vec_id"), (F.col("home") == F.col("cell")).alias("own"))
    count = visits.groupBy("cell").agg(blocks(F.count_if("own")).alias("nh"), blocks(F.count("*")).alias("nv"))
    count = F.broadcast(C.store(spark, count, "vectors-count"))  # at most MAX_CELLS rows per vector length
    mine = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["cell", "hb", "vb", "is_home", "vec_id", "copies", "embedding", "home", "visits"]
    homes = (placed.withColumn("cell", F.col("home")).join(count, "cell").withColumn("hb", mine("nh")).withColumn("vb", every("nv"))
             .withColumn("is_home", F.lit(True)).select(cols))
    guests = (placed.withColumn("cell", F.explode("visits")).join(count, "cell").withColumn("vb", mine("nv")).withColumn("hb", every("nh"))
              .withColumn("is_home", F.lit(False)).withColumn("visits", F.array().cast("array<int>")).select(cols))
    found = (homes.unionByName(guests).groupBy("cell", "hb", "vb")
             .applyInArrow(_compare(cosine), "vec_id long, links long, hub long"))
    found = C.store(spark, found, "vectors-links")
    label = components(spark, found.select(F.col("vec_id").alias("a"), F.col("hub").alias("b")).where("a <> b"))
    reach = (reps.join(found.groupBy("vec_id").agg(F.sum("links").alias("links")), "vec_id", "left")
             .join(label.withColumnRenamed("node", "vec_id"), "vec_id", "left")
             .select("embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")))
    out = base.withColumn("key", F.when(valid, F.col("embedding"))).join(reach.withColumnRenamed("embedding", "key"), "key", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
