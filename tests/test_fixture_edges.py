"""Small literal fixtures for edge rows (list cells, titles, service
schedules, chunk boundaries, undecodable bytes)."""

import os

from pyspark.sql import functions as F

from shapekit.functions.text import normalise_title
from shapekit.operators import score as SC
from shapekit.operators.pairs import parse_list_cell
from shapekit.sources import tagged
from shapekit.streaming.assemble import Progress


def test_list_cells(spark):
    rows = ['["a","b"]', "['a', 'b']", '["a",]', '"abc"', "[1, 2]", "[", "[]", None,
            "[None, True]", r"['caf\xe9', 'a\'b', '\u00fc\n', '\q']", "('a','b')", """["a" 'b', "it's"]""", "['a'] junk", "[['a']]", " [ 'x' , ] ",
            "['a' 1]", "['a',,]", r"['\101\\']"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c string")
    got = [r.a for r in df.select("i", parse_list_cell("c").alias("a")).orderBy("i").collect()]
    assert got[0] == ["a", "b"] and got[1] == ["a", "b"]
    assert got[2] == ["a"] and got[3] is None and got[5] is None and got[7] is None
    assert got[8:] == [[None, "True"], ["caf\xe9", "a'b", "\xfc\n", "\\q"], None, ["ab", "it's"], None, None, ["x"], None, None, ["A\\"]]
    assert got[4] == ["1", "2"] and got[6] == []


def test_title_normalisation(spark):
    rows = [("Reese’s  Cups",), ("reese's cups",), (" Reese's Cups ",), ("“Quoted”",), ('"quoted"',)]
    got = [r.n for r in spark.createDataFrame(rows, "t string").select(normalise_title(F.col("t")).alias("n")).collect()]
    assert got[0] == got[1] == got[2] == "reese's cups"
    assert got[3] == got[4] == '"quoted"'


def scheduled(n, permanent=False, blank=False):
    """Client failing ``n`` times per request, then answering; optional permanent
    error or blank answer.  Built inside a function so it ships by value."""
    class Scheduled:
        def __init__(self):
            self.calls = 0

        def start_row(self, tries=0):
            self.calls = tries

        def __call__(self, prompt):
            self.calls += 1
            if permanent:
                raise SC.PermanentError("no")
            if self.calls <= n:
                raise TimeoutError("slow")
            return "" if blank else '{"title":"t","ingredients":["a"],"steps":[]}'
    return Scheduled()


def _run(spark, client):
    df = spark.createDataFrame([(1, "x")], "idx long, text string")
    return SC.call_service(df, lambda: client, sleep=lambda s: None, rand=lambda: 0.5, pause=0.0).first()


def test_service_schedules(spark):
    for n, want in ((0, (1, "ok")), (1, (2, "ok")), (4, (5, "ok")), (5, (5, "error"))):
        r = _run(spark, scheduled(n))
        assert (r.attempts, r.status) == want, n
    r = _run(spark, scheduled(0, permanent=True))
    assert (r.attempts, r.status, r.error_kind) == (1, "error", "permanent")
    r = _run(spark, scheduled(0, blank=True))
    assert (r.attempts, r.status, r.error_kind) == (5, "error", "exhausted:empty")


def _assemble(chunks):
    at = Progress()
    return next((got for got in map(at.feed, chunks) if got is not None), None)


def test_chunk_boundaries():
    obj = '{"a":"x}{\\"y","b":{"c":1}}'
    assert _assemble(["pre {\"a\":\"x}", "{\\", "\"y\",\"b\":{\"c\":1", "}} tail"]) == obj   # inside a string, after a backslash
    assert _assemble(["{", "}"]) == "{}"                                                    # at the brace
    assert _assemble(["{\"a\":", "[1,2]"]) is None                                          # never closed
    assert _assemble(["no brace at all"]) is None


def test_tagged_undecodable_bytes(spark, tmp_dir):
    os.makedirs(tmp_dir, exist_ok=True)
    with open(os.path.join(tmp_dir, "t.txt"), "wb") as f:
        f.write(b"ID 1 - caf\xe9 au lait\nID 2 - plain\n")
    got = {r.id: r.text for r in tagged.read_tagged_text(spark, tmp_dir).collect()}
    assert got[2] == "plain" and got[1].startswith("caf") and "�" in got[1]
