"""Records over file splits: quoted cells, JSON arrays and markers, each against a reader of the whole file."""

import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapekit.sources import csv as CSV, sinks, splits, tagged
from shapekit.sources.outputs import read_outputs

SIZES = ["300", "134217728"]


@pytest.fixture(params=SIZES)
def split_size(request, spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield int(request.param)
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(folder, text, name="f.txt"):
    path = f"{folder}/{name}"
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def cells(rnd):
    words = ["salt", "two\nlines", 'a "quoted" word', "comma, inside", "", "\n\n", "é日", '""', "long " * rnd.choice([1, 90]), 'x\n"y",\n"z']
    return [rnd.choice(words) for _ in range(rnd.choice([2, 3, 3, 3, 3, 4, 5]))]


def test_quoted_lines_equal_whole_file_reader(spark, tmp_dir, split_size):
    rnd = random.Random(split_size)
    for name, end in (("a.csv", "\n"), ("b.csv", "\n"), ("c.csv", "\r\n")):
        rows = [["id", "t", "u"]] + [[str(i), *cells(rnd)[1:]] for i in range(150)]
        text = end.join(",".join('"' + c.replace('"', '""') + '"' if re.search('[",\n]', c) or rnd.random() < 0.3 else c for c in r) for r in rows)
        _write(tmp_dir, text + (end if rnd.random() < 0.5 else ""), name)
    cols = ["id", "t", "u"]
    got = CSV.read_tolerant_csv_with_status(spark, tmp_dir, cols, multi_line=True)
    whole = (spark.read.schema(CSV._schema(cols)).options(**CSV.OPTIONS).option("header", True).option("multiLine", True).csv(tmp_dir))
    if split_size < 2000:
        assert splits.split_lines(spark, tmp_dir).select("split").distinct().count() > 20
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, whole.select(*cols).collect()))
    assert {r.status for r in got.collect()} == {"ok", "too_long"}


def test_stray_quotes_and_blank_lines(spark, tmp_dir, split_size):
    """A quote inside of a plain cell opens nothing; blank lines are no rows."""
    text = "id,t,u\n" + "".join(f'{i},5" disk,"a\nb{i}"\n\n{i},x,y"z"\n' for i in range(60))
    got = CSV.read_tolerant_csv_with_status(spark, _write(tmp_dir, text, "s.csv"), ["id", "t", "u"], multi_line=True)
    want = sorted([(str(i), '5" disk', f"a\nb{i}", "ok") for i in range(60)] + [(str(i), "x", 'y"z"', "ok") for i in range(60)])
    assert sorted(tuple(r)[:3] for r in got.collect()) == [w[:3] for w in want]


def test_quote_state():
    """The state by runs of settled lines against a plain walk."""
    rnd = np.random.default_rng(3)
    for _ in range(200):
        n = int(rnd.integers(1, 12))
        outside, inside = rnd.random(n) < 0.4, rnd.random(n) < 0.6
        for first in (0, 1):
            state, want = bool(first), [bool(first)]
            for o, i in zip(outside, inside, strict=True):
                state = bool(i if state else o)
                want.append(state)
            assert splits.inside_before(outside, inside, first).tolist() == want


def test_empty_files(spark, tmp_dir):
    _write(tmp_dir, "", "a.csv")
    _write(tmp_dir, "id,t\n", "b.csv")
    assert CSV.read_tolerant_csv_with_status(spark, tmp_dir, ["id", "t"], multi_line=True).collect() == []


def objects(rnd, n):
    texts = ["plain", 'with "quotes" and \\ slashes', "brackets ]}{[ , inside", "é日", "", "line\nbreak", "long " * 60]
    return [{"index": i, "input": rnd.choice(texts), "output": {"title": rnd.choice(texts), "ingredients": [rnd.choice(texts)] * rnd.randrange(3),
                                                                "steps": [] if i % 5 else [rnd.choice(texts), "x"]}} for i in range(n)]


@pytest.mark.parametrize("layout", [{"indent": 2}, {"indent": 4, "ensure_ascii": False}, {}, {"separators": (",\n", ":")}, {"separators": ("\n,", " :\n")}])
def test_json_arrays_equal_parser(spark, tmp_dir, split_size, layout):
    rnd = random.Random(7)
    want = objects(rnd, 120)
    _write(tmp_dir, json.dumps(want[:70], **layout), "a.json")
    _write(tmp_dir, " \n" + json.dumps(want[70:], **layout) + "\n", "b.json")
    _write(tmp_dir, "[]", "c.json")
    _write(tmp_dir, "[\n]\n", "d.json")
    got = read_outputs(spark, tmp_dir, "m", "p", array_file=True).select(F.col("idx"), "input", "output").collect()
    rows = sorted(((r.idx, r.input, r.output.asDict()) for r in got), key=lambda r: r[0])
    assert rows == [(w["index"], w["input"], w["output"]) for w in want]


def test_json_array_sink_is_read_back(spark, tmp_dir, split_size):
    df = spark.createDataFrame([(i, None if i % 3 else "a\n]b") for i in range(200)], "index bigint, input string").coalesce(1)
    for pretty in (False, True):
        sinks.write_json_arrays(df, f"{tmp_dir}/x{pretty}", pretty=pretty)
        back = read_outputs(spark, f"{tmp_dir}/x{pretty}", "m", "p", array_file=True).select("idx", "input")
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def marked(rnd):
    words = ["flour", "acid 5", "salt\n", "ID", "iid\n7", "\n- x", "ID 12", "id\n\n 3 —", "w" * 40, "kid  9"]
    return " ".join(rnd.choice(words) + rnd.choice(["", "\n"]) for _ in range(900))


def test_loose_markers_equal_unanchored_rule(spark, tmp_dir, split_size):
    text = marked(random.Random(split_size))
    path = _write(tmp_dir, text)
    rule = re.compile(r"i?ID\s+(\d+)\s*[—-]*\s*(.*?)(?=i?ID\s+\d+|\Z)", re.S | re.I)
    want = [(int(m[1]), m[2].strip()) for m in rule.finditer(text)]
    got = tagged.read_tagged_text(spark, path, loose=True).orderBy("pos").select("id", "text").collect()
    assert [tuple(r) for r in got] == want


def test_anchored_markers_equal_line_rule(spark, tmp_dir, split_size):
    text = marked(random.Random(split_size + 1))
    path = _write(tmp_dir, text)
    want, cur = [], None
    for line in text.split("\n"):
        m = re.match(r"i?ID[^\S\n]+(\d+)[^\S\n]*[—-]*[^\S\n]*", line, re.I)
        if m:
            cur = [int(m[1]), [line[m.end():]]]
            want.append(cur)
        elif cur:
            cur[1].append(line)
    got = tagged.read_tagged_text(spark, path).orderBy("pos").select("id", "text").collect()
    assert [tuple(r) for r in got] == [(i, "\n".join(x).strip()) for i, x in want]


def test_text_stays_out_of_the_shuffle(spark, tmp_dir):
    """Only fragments are exchanged: the plan of the whole records has no exchange below the union."""
    path = _write(tmp_dir, "ID 1 - a\nb\nID 2 - c\n" * 50)
    plan = tagged.read_tagged_text(spark, path)._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("MapInArrow"):]
    assert "Union" in plan and "Exchange" not in plan[:plan.index("MapInArrow")]
    assert "Scan text" in first or "FileScan text" in first
