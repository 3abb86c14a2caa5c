"""Counts of n-grams on their way between tasks: small, and whole again where they are added up."""

from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from shapekit.llm import collocations as K

PARTS = 5


def _rows(texts, langs):
    held = SimpleNamespace(value=np.full(1 << 13, 255, np.uint8))  # every n-gram survives
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "lang": pa.array(langs, pa.string())})
    return list(K._count_some(3, 1 << 18, held, 16, PARTS)(iter([batch])))


def test_counts_travel_as_numbers_of_words_and_come_back_whole():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 40, 300)) for _ in range(40)] + ["only", "", None]
    langs = ["x" if i % 3 else None for i in range(len(texts))]
    batches = _rows(texts, langs)
    grams = Counter()
    for t, v in zip(texts, langs, strict=True):
        w = (t or "").split()
        grams.update((v or "und", len(g)) + g for k in (1, 2, 3) for g in zip(*[w[j:] for j in range(k)], strict=False))
    sent = sum(len(x.as_py()) for b in batches for c in b.columns[2:] for x in c)
    assert sent < 12 * len(grams)  # 33 bytes each as whole hashes and counts

    whole = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["part"], r["lang"]))
    merged = K._whole_counts(3, 1, 1 << 18, 10)(iter([pa.RecordBatch.from_pylist(whole, schema=batches[0].schema)]))
    hash_of = {x: K._lang_hash(x) for x in {w for g in grams for w in g[2:]}}
    want = Counter({(g[0], *[hash_of[w] for w in g[2:]]): n for g, n in grams.items()})
    got = Counter()
    for b in merged:
        for r in b.to_pylist():
            if r["lang"] is not None:
                w = [K.numbers(r[f"w{j}"], np.uint64) for j in range(3)]
                for i, (k, n) in enumerate(zip(K.numbers(r["k"], np.uint8), K.numbers(r["n"], np.int64), strict=True)):
                    got[(r["lang"], *[int(w[j][i]) for j in range(k)])] += int(n)
    assert got == want


def test_coded_words_and_counts_of_any_size():
    w = [np.array([5, 2**64 - 1, 5], np.uint64), np.zeros(3, np.uint64), np.array([7, 0, 9], np.uint64)]
    assert all((a == b).all() for a, b in zip(w, K.decoded(K.coded(w), 3), strict=True))
    many = [np.arange(70_000, dtype=np.uint64)[::-1].copy()] * 2
    assert all((a == b).all() for a, b in zip(many, K.decoded(K.coded(many), 70_000), strict=True))
    for top in (1, 255, 256, 70_000, 2**40):
        n = np.array([1, top], np.int64)
        assert (K._wide(K.planes(K._narrow(n)), 2) == n).all()
