"""First JSON block: native regex + token fold against a plain character scan."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shapekit.functions import text


def closed(s):
    """Balanced as an object, told by rewriting: strings go first, then inner pairs of braces."""
    import re
    s = re.sub(r'"(?:[^"\\]|\\.)*"', "", s, flags=re.S)
    if '"' in s:
        return False
    s = re.sub(r"[^{}]", "", s)
    while "{}" in s:
        s = s.replace("{}", "")
    return not s


def py_block(s):
    """Brute force, apart from the library: the shortest prefix from the first brace that is balanced."""
    import re
    for mark in ("```json", "```"):
        s = "".join(p if k == 0 else p.lstrip() for k, p in enumerate(re.split(re.escape(mark), s, flags=re.I)))
    s = s.strip()
    start = s.find("{")
    if start < 0:
        return None
    ends = [m.end() for m in re.finditer("}", s) if m.end() > start]
    return next((s[start:e] for e in ends if closed(s[start:e])), None)


EDGE = [
    'x {"a":"}{","b":{"c":1}} tail {}',
    '{"a": "esc \\" }" }',
    '{"a":1',
    '{"a":1 {"b":2}',            # first object never closes: the later one is not taken
    "no brace",
    "",
    '{"a":{"b":{"c":{"d":{"e":{"f":1}}}}}}',   # deeper than the regex bound
    '```json\n{"a":[1,2]}\n```',
    '{"a":"\\\\"}',
    '{"a":"lone \\',
    '}{"a":1}',
    '{"k":"' + "y" * 50000 + '"}',
    "{}",
    '{"t":"café “q”"}',
]


def _native(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, raw string")
    out = text.with_json_block(df, "raw", "blk").orderBy("i").collect()
    return [r.blk for r in out]


def test_edge_rows(spark):
    assert _native(spark, EDGE) == [py_block(s) for s in EDGE]


def test_null_input(spark):
    df = spark.createDataFrame([(None,)], "raw string")
    assert df.select(text.first_json_block(F.col("raw")).alias("b")).first().b is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet='{}"\\ab: ', max_size=30), min_size=20, max_size=20))
def test_differential_random(spark, rows):
    assert _native(spark, rows) == [py_block(s) for s in rows]


def test_long_inputs_do_not_overflow(spark):
    from shapekit.operators import validate as V
    rows = [(1, '{"title":"' + '\\n' * 60000 + '","ingredients":[],"steps":[]}'),
            (2, '{"title":"t","ingredients":[' + ','.join(['"a"'] * 60000) + '],"steps":[]}'),
            (3, '{"c":[' + ','.join(['{"x":1}'] * 30000) + ']}'),
            (4, '{' + '"k":"v",' * 40000 + '"z":1')]
    df = spark.createDataFrame(rows, "idx long, raw string")
    got = {r.idx: r.reason for r in V.validate_strict(df, outputs=("reason",)).collect()}
    assert got == {1: None, 2: None, 3: "bad_keys", 4: "no_json"}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet='{{{}}}"\\a', max_size=60), min_size=20, max_size=20))
def test_differential_deep_nesting(spark, rows):
    # brace-heavy rows go past the regex depth bound and exercise the token fold
    assert _native(spark, rows) == [py_block(s) for s in rows]
