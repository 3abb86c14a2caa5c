"""Stored extraction outputs and the hand-kept error ledger.

Result and failure files come as JSON arrays (one document per file, of any layout over lines)
or JSON lines.  Loading adds ``model`` and ``phase`` and normalises two
differences between runs: the failure index base (0 or 1) and an empty
``json_str`` written where no block was found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapekit.sources.lines import fill_down, read_lines
from shapekit.sources.splits import array_elements

OUTPUT_SCHEMA = "title string, ingredients array<string>, steps array<string>"
RESULT_SCHEMA = f"index bigint, input string, output struct<{OUTPUT_SCHEMA}>"
FAILURE_SCHEMA = "index bigint, reason string, recipe_text string, raw string, json_str string"


def read_outputs(spark: SparkSession, path: str, model: str | None, phase: str | None,
                 kind: str = "result", base: int = 0, array_file: bool = False) -> DataFrame:
    """Rows of a result or failure file with ``idx`` 0-based and ``json_str`` "" -> null.

    ``model`` / ``phase`` None: the files carry those fields themselves.
    """
    schema = RESULT_SCHEMA if kind == "result" else FAILURE_SCHEMA
    for name, given in (("model", model), ("phase", phase)):
        if given is None:
            schema += f", {name} string"
    if array_file:  # elements are found split by split, so one large file is many tasks
        df = array_elements(spark, path).select(F.from_json("value", schema).alias("r")).select("r.*")
    else:
        df = spark.read.schema(schema).json(path)
    df = df.withColumn("idx", F.col("index") - F.lit(base)).drop("index")
    if kind == "failure":
        df = df.withColumn("json_str", F.when(F.col("json_str") != "", F.col("json_str")))
    if model is not None:
        df = df.withColumn("model", F.lit(model))
    if phase is not None:
        df = df.withColumn("phase", F.lit(phase))
    return df.withColumn("kind", F.lit(kind))


# The ledger's words.  Check headers, the phase headers and
# the item that means "none".
LEDGER_CHECKS = {
    "SINTASSI": "syntax",
    "STRUTTURA": "structure",
    "SEMANTICA": "semantic",
    "SINTASSI / STRUTTURA": "syntax_or_structure",
}
LEDGER_PHASES = {"INFERENZA": "before", "FASE DI VALUTAZIONE": "after"}
LEDGER_NONE = "nessuna"

_CHECK_RE = r"^\s*([A-Z][A-Z /]*[A-Z])\s*\((\d+)\)\s*:\s*$"
_MODEL_RE = r"^\s*\[([^\]]+)\]\s*$"
_ITEM_RE = r"^\s*-\s?(.*)$"


def _map_lit(d: dict):
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(phase, model, check, declared, title): one row per listed item.

    A check with no items ("- none") gives one row with a null title, so its
    declared count is kept.  Headers are carried down to item lines.
    """
    ln = read_lines(spark, path)
    s = F.trim(F.col("line"))
    d = ln.select(
        "file", "block", "ln",
        _map_lit(LEDGER_PHASES)[s].alias("p"),
        F.when(F.regexp_extract("line", _MODEL_RE, 1) != "", F.regexp_extract("line", _MODEL_RE, 1)).alias("m"),
        F.when(F.regexp_extract("line", _CHECK_RE, 1) != "",
               F.struct(F.regexp_extract("line", _CHECK_RE, 1).alias("name"),
                        F.regexp_extract("line", _CHECK_RE, 2).cast("int").alias("declared"))).alias("c"),
        F.when(s.startswith("-"), F.trim(F.regexp_extract("line", _ITEM_RE, 1))).alias("item"))
    # a model header resets the check, a phase header resets model and check
    d = d.withColumn("c", F.when(F.col("m").isNotNull() | F.col("p").isNotNull(),
                                 F.struct(F.lit("").alias("name"), F.lit(None).cast("int").alias("declared")))
                     .otherwise(F.col("c")))
    d = d.withColumn("m", F.when(F.col("p").isNotNull(), F.lit("")).otherwise(F.col("m")))
    d = fill_down(d, ["p", "m", "c"], ["phase", "model", "chk"])
    items = d.filter(F.col("item").isNotNull() & (F.col("chk.name") != ""))
    checks = _map_lit(LEDGER_CHECKS)
    return items.select(
        "phase", F.col("model"),
        F.coalesce(checks[F.col("chk.name")], F.lower(F.col("chk.name"))).alias("check"),
        F.col("chk.declared").alias("declared"),
        F.when(F.lower(F.col("item")) != LEDGER_NONE, F.col("item")).alias("title"))


def ledger_lines(failures: DataFrame) -> DataFrame:
    """Ledger text from (phase, model, check, title) failure rows -> (k1, k2, k3, k4, line).

    Written in key order this gives the sectioned layout: a phase header, a
    ``[MODEL]`` line per model, ``CHECK (n):`` per check, ``- title`` items.
    """
    inv_phase = {v: k for k, v in LEDGER_PHASES.items()}
    inv_check = {v: k for k, v in LEDGER_CHECKS.items()}
    f = failures.withColumn("ph", _map_lit(inv_phase)[F.col("phase")]) \
                .withColumn("ck", _map_lit(inv_check)[F.col("check")])
    counts = f.groupBy("ph", "model", "ck").agg(F.count("title").alias("n"))
    phases = f.select("ph").distinct().select("ph", F.lit("").alias("model"), F.lit("").alias("ck"),
                                              F.lit(0).alias("o"), F.lit("").alias("t"), F.col("ph").alias("line"))
    models = f.select("ph", "model").distinct().select(
        "ph", "model", F.lit("").alias("ck"), F.lit(0).alias("o"), F.lit("").alias("t"),
        F.concat(F.lit("["), F.col("model"), F.lit("]")).alias("line"))
    heads = counts.select("ph", "model", "ck", F.lit(0).alias("o"), F.lit("").alias("t"),
                          F.concat(F.col("ck"), F.lit(" ("), F.col("n").cast("string"), F.lit("):")).alias("line"))
    items = f.filter(F.col("title").isNotNull()).select(
        "ph", "model", "ck", F.lit(1).alias("o"), F.col("title").alias("t"),
        F.concat(F.lit("- "), F.col("title")).alias("line"))
    none = counts.filter(F.col("n") == 0).select("ph", "model", "ck", F.lit(1).alias("o"), F.lit("").alias("t"),
                                                 F.lit("- " + LEDGER_NONE).alias("line"))
    return phases.unionByName(models).unionByName(heads).unionByName(items).unionByName(none)
