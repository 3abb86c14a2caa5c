"""Near copies whose differences lie in few of many directions are all found."""

import numpy as np

from shapekit.llm import embed_dedup


def test_low_rank_vectors_lose_no_link(spark):
    rng = np.random.default_rng(8)
    turn = rng.uniform(0, 2 * np.pi, 300)
    flat = np.stack((np.cos(turn), np.sin(turn)), 1) @ np.linalg.qr(rng.normal(size=(512, 2)))[0].T
    x = flat.astype(np.float32)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in embed_dedup.vector_groups(spark, d).collect()}
    v = x.astype(float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    want = (v @ v.T >= 0.95).sum(1) - 1
    assert [got[i] for i in range(len(x))] == want.tolist()
