"""Every labelled language is learned, and texts stay where there is no label."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapekit.llm import lang_id


def corpus(languages, each):
    """Languages ``q0``, ``q1`` … of own words, the last ones rarer, in ``each`` documents."""
    rnd = random.Random(3)
    rows = []
    for k in range(languages):
        words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(8)]
        for _ in range(each + (k < languages - 10)):
            rows.append((len(rows), " ".join(rnd.choice(words) for _ in range(30)), f"q{k}"))
    return rows


def accuracy(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in lang_id.language_summary(spark, d).collect()}
    return {v: np.mean([got[i] == v for i, _, x in rows if x == v]) for _, _, v in rows}


def test_more_than_two_hundred_languages(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "EPOCHS", 10)
    right = accuracy(spark, corpus(210, 5))
    assert len(right) == 210 and min(right.values()) > 0.5 and np.mean(list(right.values())) > 0.95


@pytest.mark.parametrize("name", ["en-x{}", "v{}"])
def test_jobs_learn_what_one_task_learns(spark, monkeypatch, name):
    rows = [(i, t, name.format(v)) for i, t, v in corpus(7, 12)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one = lang_id.train(spark, d)
    monkeypatch.setattr(lang_id, "FAMILIES_A_TASK", 2)
    monkeypatch.setattr(lang_id, "PAIRS_A_TASK", 4)
    many = lang_id.train(spark, d)
    assert one.members == many.members and one.pairs.keys() == many.pairs.keys() and len(one.members) in (1, 7)
    assert np.allclose(one.top, many.top, atol=1e-4)
    assert all(np.allclose(one.pairs[k], many.pairs[k], atol=1e-4) for k in one.pairs)


def test_no_label_keeps_texts(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, "12 !?"), (3, None), (4, "é")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in lang_id.known_language(spark, docs).collect()) == [1, 4]
