"""Jaccard components where one doc_id has several texts, and the stage on clashing column names."""

import random

import pytest

from shapekit.llm import shingle_join


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    near = {i: {i} for i, _ in rows if i is not None}
    for x, (i, _) in enumerate(rows):
        for y, (j, _) in enumerate(rows):
            if x < y and i is not None and j is not None and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                    near[i].add(j)
                    near[j].add(i)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = min(seen)
    return sorted(((i, len(s), None if i is None else out[i]) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def texts(seed, n):
    rnd = random.Random(seed)
    return [" ".join(rnd.choices(["aa", "bb", "cc", "dd", "ee", "ff", "gg"], k=60)) for _ in range(n)]


A, B, D, E = texts(1, 4)


@pytest.mark.parametrize("rows", [
    [(1, A), (1, B), (2, A + " x"), (3, B + " y")],
    [(3, A), (3, B), (2, A + " x"), (1, B + " y"), (9, D), (9, None), (9, D), (8, D + " z"), (None, A), (7, "")],
    [(5, A), (5, B), (5, D), (4, A), (6, D + " q"), (6, E), (2, E + " r"), (10, E), (11, E), (-3, "one two"), (12, "One TWO")]])
def test_ids_with_several_texts(spark, rows):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n int").repartition(3)
    got = sorted((tuple(r) for r in shingle_join.jaccard_components(spark, docs).collect()), key=str)
    assert got == brute(rows)


def test_long_documents_with_shared_passages(spark):
    """Long texts that share passages, some of them near copies, and shorter ones: against brute force."""
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(5000)}"
    passages = [[word() for _ in range(400)] for _ in range(4)]
    rows = []
    for i in range(60):
        words = [word() for _ in range(rnd.choice([40, 300, 2500]))]
        for p in rnd.sample(passages, 2):
            words[10:10] = p
        rows.append((i, " ".join(words)))
        if i % 6 == 0:
            for k in range(rnd.randrange(8)):
                rows.append((rnd.randrange(100, 10**6), " ".join(words) + f" tail {k} {word()}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted((tuple(r) for r in shingle_join.jaccard_components(spark, docs).collect()), key=str) == brute(rows)


def test_stage_keeps_columns_with_dots(spark):
    rows = [(1, A, "x"), (2, A + " end", "y"), (3, B, None), (3, B, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    out = shingle_join.without_near_copies(spark, docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]
    assert shingle_join.without_near_copies(spark, docs.limit(0)).collect() == []
