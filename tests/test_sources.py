"""Tolerant CSV, tagged text (anchored and loose markers, records across
file splits), ledger round trip."""

import os

from pyspark.sql import functions as F

from shapekit.sources import csv as CSV, tagged
from shapekit.sources.outputs import read_ledger, read_outputs


def _write(path, text, name="f.txt"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_tolerant_csv(spark, tmp_dir):
    text = (',title,ingredients,directions\n'
            '1,"a","[""x""]","[""y""]"\n'
            '2,"b"\n'                                   # short: kept
            '3,"c","i","d","extra"\n'                   # one extra cell: skipped
            '4,"e","i","d","x","y"\n'                   # two extra cells: skipped
            '7,a,b,c,,y\n8,a,b,c,,\n'                   # empty extra cells: skipped
            '5,"f","multi\nline","d"\n'                 # quoted newline
            '6,"say ""hi""","i",""\n')                  # doubled quotes, empty cell
    p = _write(tmp_dir, text, "f.csv")
    good, bad = CSV.read_tolerant_csv(spark, p, ["id", "title", "ingredients", "directions"], multi_line=True)
    g = {r.id: r for r in good.collect()}
    assert sorted(g) == ["1", "2", "5", "6"]
    assert g["2"].ingredients is None
    assert g["5"].ingredients == "multi\nline"
    assert g["6"].title == 'say "hi"'
    assert sorted(r.id for r in bad.collect()) == ["3", "4", "7", "8"]
    # a narrow projection judges rows the same way
    assert sorted(r.id for r in good.select("id").collect()) == ["1", "2", "5", "6"]


def test_unterminated_quote_is_set_aside(spark, tmp_dir):
    p = _write(tmp_dir, ',title,a,b\n1,"t","x","y"\n2,"open,x,y\n3,t,"q""q",\n', "f.csv")
    df = CSV.read_tolerant_csv_with_status(spark, p, ["id", "title", "a", "b"])
    assert sorted((r.id, r.status) for r in df.collect()) == [("1", "ok"), ("2", "unterminated_quote"), ("3", "ok")]


def test_tagged_anchored_and_loose(spark, tmp_dir):
    text = ("preamble without a marker\n"
            "ID 1 — first text\nsecond line\n"
            "iID 2 - add the acid 5 drops\n"
            "ID 3 no dash\n"
            "ID 1 - replaced\n")
    p = _write(tmp_dir, text)
    t = tagged.read_tagged_text(spark, p)
    last = {r.id: r.text for r in tagged.latest_per_key(t).collect()}
    assert last == {1: "replaced", 2: "add the acid 5 drops", 3: "no dash"}
    all_rows = sorted((r.id, r.text) for r in t.collect())
    assert (1, "first text\nsecond line") in all_rows
    loose = {r.id: r.text for r in tagged.latest_per_key(tagged.read_tagged_text(spark, p, loose=True)).collect()}
    assert loose[2] == "add the ac" and loose[5] == "drops"      # "acid 5" splits a record


def test_tagged_across_splits(spark, tmp_dir):
    recs = [(i, f"line one of {i}\n" + ("filler words here\n" * (i % 7 + 1)) + "end") for i in range(300)]
    text = "".join(f"ID {i} - {body}\n" for i, body in recs)
    p = _write(tmp_dir, text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        t = tagged.read_tagged_text(spark, p)
        assert spark.read.text(p).rdd.getNumPartitions() > 5
        got = {r.id: r.text for r in t.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == dict(recs)


def test_ledger_parse(spark, tmp_dir):
    text = ("INFERENZA\n\n[MODEL A]\n\nSINTASSI / STRUTTURA (2):\n- Cake One\n- Pie\n\nSEMANTICA (1):\n- Soup\n\n"
            "[MODEL-B]\n\nSINTASSI (0):\n- nessuna\n\n\nFASE DI VALUTAZIONE\n\n[MODEL A 2]\n\nSEMANTICA (1):\n- Stew\n")
    p = _write(tmp_dir, text)
    rows = sorted(((r.phase, r.model, r.check, r.declared, r.title) for r in read_ledger(spark, p).collect()), key=str)
    assert rows == sorted([("after", "MODEL A 2", "semantic", 1, "Stew"),
                    ("before", "MODEL-B", "syntax", 0, None),
                    ("before", "MODEL A", "semantic", 1, "Soup"),
                    ("before", "MODEL A", "syntax_or_structure", 2, "Cake One"),
                    ("before", "MODEL A", "syntax_or_structure", 2, "Pie")], key=str)


def test_read_outputs_array_and_base(spark, tmp_dir):
    text = ('[\n  {"index": 7, "reason": "no_json", "recipe_text": "t", "raw": "{", "json_str": ""},\n'
            '  {"index": 12, "reason": "no_json", "recipe_text": "u", "raw": "{x", "json_str": ""}\n]\n')
    p = _write(tmp_dir, text, "failures.json")
    df = read_outputs(spark, p, "m", "after", kind="failure", base=1, array_file=True)
    rows = sorted((r.idx, r.json_str, r.model) for r in df.collect())
    assert rows == [(6, None, "m"), (11, None, "m")]


def test_pairs_roundtrip(spark, tmp_dir):
    from shapekit.sources import sinks
    df = spark.createDataFrame([(1, 'text with "quotes"\nand a newline', '{"a":1}')], "id long, text string, json string")
    sinks.write_csv(df, tmp_dir + "/p")
    back = CSV.read_pairs(spark, tmp_dir + "/p").collect()
    assert [(r.id, r.text, r.json) for r in back] == [(1, 'text with "quotes"\nand a newline', '{"a":1}')]
    assert back and F  # noqa


def test_write_quarantine(spark, tmp_dir):
    from shapekit.operators import validate as V
    from shapekit.sources import sinks
    df = spark.createDataFrame([(0, '{"title":"a","ingredients":[],"steps":[]}'), (1, "x")], "idx long, raw string")
    sinks.write_quarantine(V.validate_strict(df, outputs=("reason", "ok")), tmp_dir + "/q")
    back = spark.read.json(tmp_dir + "/q")
    assert sorted((r.idx, r.status, r.reason) for r in back.collect()) == [(0, "ok", None), (1, "failed", "no_json")]
