"""Ledger reconciliation both ways, distances, grounding, faults, run matching and resumable requests."""

import json
import random

import pytest
from pyspark.sql import functions as F

from shapekit.functions.distance import _far, _near, edit_distance
from shapekit.functions.jsonfault import json_fault
from shapekit.operators import audit as AU, metrics, score as SC, validate as V
from shapekit.plans import stubs


def test_reconcile_both_ways(spark):
    cols = "phase string, model string, check string, declared int, title string"
    ledger = spark.createDataFrame([
        ("before", "a", "syntax", 0, None),                                                      # two failures nobody listed
        ("before", "a", "structure", 3, "Soup"), ("before", "a", "structure", 3, "soup "), ("before", "a", "structure", 3, "Cake"),
        ("after", "a", "syntax", 2, "Pie")], cols)
    stored = spark.createDataFrame([
        ("before", "a", "syntax", "X"), ("before", "a", "syntax", "Y"), ("before", "a", "structure", "SOUP"),
        ("before", "b", "semantic", "Z"), ("before", "b", "semantic", "Z"), ("after", "a", "syntax", "Pie"), ("after", "a", "syntax", "Pie")],
        "phase string, model string, check string, title string")
    results = spark.createDataFrame([("before", "a", "cake")], "phase string, model string, title string")
    got = {(r.phase, r.model, r.check): r for r in AU.reconcile_ledger(ledger, stored, results).collect()}
    names = ["declared", "listed", "stored", "listed_stored", "listed_unstored", "stored_unlisted", "listed_again", "listed_in_results",
             "count_mismatch", "stored_mismatch"]
    rows = {k: tuple(r[n] for n in names) for k, r in got.items()}
    assert rows == {
        ("before", "a", "syntax"): (0, 0, 2, 0, 0, 2, 0, 0, False, True),
        ("before", "a", "structure"): (3, 3, 1, 1, 2, 0, 1, 1, False, True),
        ("before", "b", "semantic"): (None, 0, 2, 0, 0, 2, 0, 0, False, True),
        ("after", "a", "syntax"): (2, 1, 2, 1, 0, 1, 0, 0, True, False)}


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rnd = random.Random(2)
    for _ in range(600):
        a = "".join(rnd.choice("abé日") for _ in range(rnd.randrange(40)))
        b = "".join(c if rnd.random() < 0.8 else rnd.choice(["", "x", "ab"]) for c in a) if rnd.random() < 0.6 else \
            "".join(rnd.choice("abé日") for _ in range(rnd.randrange(40)))
        want = plain_distance(a, b)
        assert edit_distance(a, b) == want
        if a and b:
            assert _far(a, b) == want and _near(a, b, 5) == (want if want <= 5 else None)


def test_long_step_lists(spark):
    """20,000 words with differences at the head, inside and at the tail."""
    rnd = random.Random(3)
    steps = [" ".join(rnd.choice(["mix", "stir", "bake", "salt"]) for _ in range(10)) for _ in range(2000)]
    other = ["a new first step", *steps[:900], *steps[905:], "and a last one"]
    kind = "idx long, {} struct<title: string, ingredients: array<string>, steps: array<string>>"
    one = spark.createDataFrame([(1, ("T", ["x"], steps)), (2, ("T", [], ["ab"])), (3, ("T", [], steps)), (4, ("T", [], []))], kind.format("output"))
    two = spark.createDataFrame([(1, ("T", ["x"], other)), (2, ("T", [], ["b", "c"])), (3, ("T", [], steps)), (4, ("T", [], steps))], kind.format("gold"))
    got = {r.idx: r.steps_edit for r in AU.score_against_gold(one, two).collect()}
    assert got == {1: edit_distance("\n".join(steps), "\n".join(other)), 2: plain_distance("ab", "b\nc"), 3: 0, 4: len("\n".join(steps))}


def test_grounding_counts_substrings(spark):
    text = "Red Onion\nsalt and pepper\nolive oil"
    items = ["red onion", "Onion", "pepper\nolive", "PEPPER", "garlic", "garlic", "", "nion\nsalt", "x"]
    out = spark.createDataFrame([("m", 1, (items,)), ("m", 2, ([],)), ("n", 1, (["a", "olive oil"],))],
                                "model string, idx int, output struct<ingredients: array<string>>")
    prompts = spark.createDataFrame([("m", 1, text), ("m", 2, text), ("n", 1, "")], "model string, idx int, text string")
    got = {r.model: (r.n_items, r.n_found) for r in AU.grounding(out, prompts).collect()}
    assert got == {"m": (9, sum(x.lower() in text.lower() for x in items)), "n": (2, 0)}


FAULTS = ['{"a":1,}', '{"a":[1,2,]}', '{"a":"x', '{"a" 1}', "{a:1}", "{'a':1}", '{"a":"b\\x"}', '{"a":"b\nc"}', '{"a":1}  x', '{"a":[1,2}',
          '{"a":1 "b":2}', '{"a":}', "{,}", '{"a":1,,"b":2}', '{"a":[1 2]}', '[1,2', '{"a":1', '{"a":tru}', '{"a":1}}', '{"a"}', '{"a":1:2}',
          "[,1]", '{"a":"é日\\q"}', '{"a": "b\\', "[]x", '{"x":[{"y":[]},{"z":{}}],}', '{"a":1 , \n}']


def test_json_fault_place(spark):
    """Kinds as named, offsets as of Python's parser."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(FAULTS)], "i int, t string")
    got = {r.i: r.f for r in df.select("i", json_fault(F.col("t")).alias("f")).collect()}
    for i, t in enumerate(FAULTS):
        with pytest.raises(json.JSONDecodeError) as e:
            json.loads(t)
        assert got[i].endswith(f" at {e.value.pos}"), (t, got[i], e.value)
    kinds = {got[i].split(" at ")[0] for i in got}
    assert kinds == {"trailing comma", "unclosed string", "missing colon", "bare word", "bad escape", "control character", "trailing text",
                     "wrong bracket", "missing comma", "missing value", "missing key", "unclosed", "wrong colon"}


def test_reason_text_and_histogram(spark):
    df = spark.createDataFrame([(1, 'x {"title":"a",}'), (2, '{"title":"a","steps":[],"ingredients":[]}'), (3, "none")], "idx int, raw string")
    v = V.validate_lenient(df, outputs=("ok", "reason", "reason_text"))
    assert {r.idx: r.reason_text for r in v.collect()} == {1: "invalid_json: trailing comma at 12", 2: None, 3: "no_json"}
    told = v.withColumn("reason", F.col("reason_text")).withColumn("phase", F.lit("p"))
    assert {r.reason: r.n for r in metrics.failure_histogram(told).collect()} == {"invalid_json": 1, "no_json": 1}


def test_match_runs(spark):
    a = spark.createDataFrame([(1, "Soup"), (2, "Cake"), (3, "pie  x"), (4, "Twin"), (5, "Twin"), (6, ""), (None, "Alone")], "idx long, title string")
    b = spark.createDataFrame([(1, "other"), (20, "“cake”"), (21, "CAKE"), (30, "Pie x"), (40, "twin"), (60, ""), (None, None)], "idx long, title string")
    got = sorted(((r.key_a, r.key_b, r.status) for r in AU.match_runs(a, b).collect()), key=str)
    assert got == sorted([(1, 1, "by_key"), (2, 21, "by_title"), (3, 30, "by_title"), (4, None, "ambiguous"), (5, None, "ambiguous"),
                          (None, 40, "ambiguous"), (None, 20, "only_b"), (6, None, "only_a"), (None, None, "only_a"), (None, 60, "only_b"),
                          (None, None, "only_b")], key=str)


def test_requests_resume(spark, tmp_dir):
    """A run that dies asks, when run again, only for what it had not committed; equal requests are asked once."""
    asked = spark.sparkContext.accumulator(0)
    rows = [(i, f"prompt {i % 40}") for i in range(60)] + [(60, None)]
    df = spark.createDataFrame(rows, "idx int, text string").repartition(3)
    store = f"{tmp_dir}/answers"

    # a prompt of the last of the six jobs
    job = F.pmod(F.xxhash64(SC.request_key(F.col("text"), "", 700)), F.lit(6))
    late = df.filter("text IS NOT NULL").withColumn("job", job).orderBy(F.desc("job")).first().text

    def failing(limit):
        def make():
            fn = stubs.make_rule_model()

            def model(prompts, tokens, system):
                if limit is not None and limit in prompts:
                    raise RuntimeError("executor lost")
                asked.add(len(prompts))
                return fn(prompts, tokens, system)
            return model
        return make
    with pytest.raises(Exception, match="executor lost"):
        SC.score_requests(df, failing(late), store, partitions=2, chunk_rows=4, run="one")
    stored = spark.read.schema(SC.ANSWERS).parquet(store).count()
    assert stored > 20
    before = asked.value
    out = SC.score_requests(df, failing(None), store, partitions=2, chunk_rows=4, run="two")
    assert asked.value - before == 41 - stored
    assert {r.idx: r.raw for r in out.collect()} == {i: stubs.answer(len(t or "") % 10, t or "") for i, t in rows}
    SC.score_requests(df, failing(None), store, run="three")
    assert asked.value - before == 41 - stored  # nothing left to ask
    again = SC.score_requests(df, failing(None), store, run="four", max_new_tokens=9)
    assert asked.value - before == 41 - stored + 41 and {r.run for r in again.collect()} == {"four"}


def test_attempts_are_judged_once(spark):
    """The result of a retry run reads stored verdicts: no validator in its plan."""
    df = spark.createDataFrame([(1, "x" * 13), (2, "y" * 20)], "idx long, text string")
    plan = SC.score_with_retry(df, stubs.make_rule_model, [SC.Attempt("a", 1), SC.Attempt("b", 2)])._jdf.queryExecution().executedPlan().toString()
    assert "try_parse_json" not in plan and "MapInPandas" not in plan
    service = SC.call_service(df, stubs.make_flaky_service, sleep=lambda s: None, rand=lambda: 0.5, pause=0.0)
    assert "try_parse_json" not in service._jdf.queryExecution().executedPlan().toString()
