"""Edge rows of the strict, lenient and api validators."""

from shapekit.operators import validate as V


def _run(spark, fn, rows, **kw):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "idx long, raw string")
    return {r.idx: r for r in fn(df, **kw).collect()}


def test_strict(spark):
    rows = ['{"title":"a","ingredients":["x"],"steps":["y"]}',
            '{"title":"a","ingredients":"x","steps":["y"]}',       # no type check
            '{"title":"a","ingredients":["x"]}',
            '{"title":"a","ingredients":["x"],"steps":[],}',
            '{"title":"a"',
            'plain text',
            '{"title":"a","title":"b","ingredients":[],"steps":[]}']  # duplicate key, last wins
    r = _run(spark, V.validate_strict, rows)
    assert [r[i].reason for i in range(7)] == [None, None, "bad_keys", "invalid_json", "no_json", "no_json", None]
    assert r[2].missing_keys == ["steps"] and r[2].extra_keys == []
    assert r[4].detail == "unclosed" and r[5].detail == "no_brace"
    assert r[6].output.title == "b"


def test_lenient(spark):
    rows = ["{}",
            '{"title":"a","ingredients":null,"steps":[]}',
            '{"title":"a","ingredients":["x"],"directions":["d"]}',
            '{"title":"a","ingredients":["x"],"steps":["s"],"directions":["d"]}',
            '{"title":5,"ingredients":[],"steps":[]}',
            '{"title":"a","ingredients":[1,{"q":2}],"steps":[],"extra":true}']
    r = _run(spark, V.validate_lenient, rows)
    assert r[0].ok and r[0].is_vacuous and r[0].output.title == ""
    assert r[1].reason == "bad_types"
    assert r[2].ok and r[2].output.steps == ["d"]
    assert r[3].output.steps == ["s"]                      # canonical key wins over the alias
    assert r[4].reason == "bad_types"
    assert r[5].ok and r[5].output.ingredients == ["1", '{"q":2}']


def test_api(spark):
    rows = ["", "   ", '[{"title":"a"}]', '{"title":"a","ingredients":"abc","steps":null}',
            'Here: {"title":0,"ingredients":[1,true,null],"steps":["s"]} bye',
            '{"title":"a","ingredients":5}', 'no json here', '{"a":1} {"b":2}',
            '{"title":"a","ingredients":{"k":1,"j":2}}']
    r = _run(spark, V.validate_api, rows)
    assert r[0].reason == "empty" and r[1].reason == "empty"
    assert r[2].reason == "not_object"
    assert r[3].ok and r[3].output.ingredients == ["abc"] and r[3].coerced and r[3].output.steps == []
    assert r[4].ok and r[4].output.title == "" and r[4].output.ingredients == ["1", "True", "None"]
    assert r[5].reason == "not_iterable"
    assert r[6].reason == "non_json"
    assert r[7].reason == "invalid_json"
    assert sorted(r[8].output.ingredients) == ["j", "k"]
    p = _run(spark, V.validate_api, rows, parity=True)
    assert p[3].output.ingredients == ["a", "b", "c"]


def test_quarantine_and_inline(spark):
    df = spark.createDataFrame([(0, '{"title":"a","ingredients":[],"steps":[]}'), (1, "x")], "idx long, raw string")
    v = V.validate_api(df)
    good, bad = V.split_quarantine(v)
    assert [r.idx for r in good.collect()] == [0] and [r.idx for r in bad.collect()] == [1]
    rows = {r.idx: r for r in V.inline_errors(v).collect()}
    assert rows[1].output.title == "" and rows[1].error == "non_json" and rows[1]["index"] == 1
    assert rows[0].error is None


def test_pick_attempt(spark):
    rows = [("r", 1, 1, False, "no_json"), ("r", 1, 2, True, None), ("r", 1, 3, True, None),
            ("r", 2, 1, False, "a"), ("r", 2, 2, False, "b")]
    df = spark.createDataFrame(rows, "run string, idx long, attempt int, ok boolean, reason string")
    out = {r.idx: r for r in V.pick_attempt(df).collect()}
    assert out[1].attempt == 2 and out[1].ok and out[1].n_attempts == 3
    assert out[2].attempt == 2 and out[2].reason == "b"


def test_exclude_ids_table_and_keep_only(spark):
    from shapekit.operators.pairs import exclude_ids, keep_only
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, t string")
    ids = spark.createDataFrame([(2,)], "id long")
    assert sorted(r.id for r in keep_only(exclude_ids(df, ids), ["id"]).collect()) == [1, 3]


def test_combined_reasons_match_separate_validators(spark):
    from shapekit.sources import derived
    from tests.conftest import SF_SMALL
    runs = derived.phase_runs(spark, SF_SMALL).select("phase", "idx", "raw")
    both = {(r.phase, r.idx): (r.strict_reason, r.lenient_reason) for r in V.validate_reasons(runs).collect()}
    s = {(r.phase, r.idx): r.reason for r in V.validate_strict(runs, outputs=("reason",)).collect()}
    le = {(r.phase, r.idx): r.reason for r in V.validate_lenient(runs, outputs=("reason",)).collect()}
    assert both == {k: (s[k], le[k]) for k in s}


def test_api_accepts(spark):
    good = ['{"a":1} x', 'x {"a":1} y', '{"title":null,"ingredients":null,"steps":null}', '{"ingredients":{"k":1}}', '[1] {"a":1}']
    bad = ["", "  ", "[1]", '[{"a":1}]', '"s"', "5", '{"title":"a","ingredients":5}', '{"ingredients":true}', "null", '{"a":NaN}']
    df = spark.createDataFrame([(r,) for r in good + bad], "raw string")
    rows = V.validate_api(df, outputs=("ok",)).collect()
    assert {r.raw for r in rows if r.ok} == set(good)


def test_custom_output_spec(spark):
    from shapekit.functions.jsonx import OutputSpec
    spec = OutputSpec(title_field="name", list_fields=("items",), aliases={"items": "things"})
    rows = ['{"name":"a","items":["x"]}', '{"name":"a","things":["y"]}', '{"name":"a","items":["x"],"z":1}',
            '{"name":1,"items":[]}', '{"name":"a","items":"x"}']
    s = _run(spark, V.validate_strict, rows, spec=spec)
    assert [s[i].reason for i in range(5)] == [None, "bad_keys", "bad_keys", None, None]
    le = _run(spark, V.validate_lenient, rows, spec=spec)
    assert [le[i].reason for i in range(5)] == [None, None, None, "bad_types", "bad_types"]
    assert le[1].output["items"] == ["y"]
    api = _run(spark, V.validate_api, rows, spec=spec)
    assert api[4].ok and api[4].output["items"] == ["x"] and api[3].output["name"] == "1"
