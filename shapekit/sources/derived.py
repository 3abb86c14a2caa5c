"""Inputs that Spark derives from the given tables.

The data folders hold generic tables; the extraction workload is laid over
them as follows (all row-wise, so the work grows with the tables):

* raw model answers: the whole text of each document as a JSON object (first line the
  title, further lines items and steps in turn), in one of eleven variants picked by a key
  formula (plain, fenced, prose around, never closed, no brace, trailing comma,
  extra key, alias key, list as string, braces inside strings + second object, empty object);
* runs: phase ``before`` and ``after`` use different variant formulas;
  ``documents.source`` names the model;
* gold objects: one per order, the part names of its line items (by line
  number) as the list field, and line descriptions as the steps;
* semantic verdicts: ``labels.quality``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapekit.sources.tables import table

# The variant formulas of the answer generator.
PHASE_KEYS = {
    "before": lambda i: i % 10,
    "after": lambda i: (i + F.floor(i / 10)) % 10,
}


def answer_fields(text: Column, i: Column) -> tuple[Column, Column, Column]:
    """(title, ingredients, steps) of a whole text: its first line, and its further lines in turn.

    Rows with ``i % 8 == 3`` list one item that the text does not hold."""
    lines = F.split(text, "\n", -1)
    rest = F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1)))
    odd = F.filter(rest, lambda x, n: n % 2 == 0)
    ing = F.concat(odd, F.when(i % 8 == 3, F.array(F.lit("unlisted item"))).otherwise(F.array().cast("array<string>")))
    return lines[0], ing, F.filter(rest, lambda x, n: n % 2 == 1)


def variant(k: Column, i: Column) -> Column:
    """Variant 10, an empty object, replaces that of every 50th row."""
    return F.when(i % 50 == 20, 10).otherwise(k)


def gen_answer(k: Column, text: Column, i: Column) -> Column:
    """One raw model answer of variant ``k`` that holds the whole text, JSON-escaped.

    Answers that must have no closed object (3, 4) hold no braces."""
    title, ing, steps = answer_fields(text, i)
    t = F.regexp_replace(F.to_json(F.array(title)), r"^\[|\]$", "")
    ings, step_list = F.to_json(ing), F.to_json(steps)

    def obj(head="", ing_=None, steps_key="steps", last='"x"', tail=""):
        body = F.regexp_replace(step_list, r"\]$", "")
        comma = F.when(F.size(steps) > 0, ",").otherwise("") if last else F.lit("")
        return F.concat(F.lit("{" + head + '"title":'), t, F.lit(',"ingredients":'), ings if ing_ is None else ing_,
                        F.lit(f',"{steps_key}":'), body, comma, F.lit(last + "]" + tail + "}"))
    g = obj()
    bare = lambda c: F.translate(c, "{}", "()")
    return (F.when(k == 0, g)
            .when(k == 1, F.concat(F.lit("```json\n"), g, F.lit("\n```")))
            .when(k == 2, F.concat(F.lit("Sure, here it is: "), g, F.lit(" Done.")))
            .when(k == 3, F.concat(F.lit("{"), bare(F.substring(g, F.lit(2), F.length(g) - 2))))
            .when(k == 4, bare(text))
            .when(k == 5, obj(tail=","))
            .when(k == 6, obj(head='"note":1,'))
            .when(k == 7, obj(steps_key="directions"))
            .when(k == 8, obj(ing_=t, last=""))
            .when(k == 9, F.concat(obj(last='"a } b { \\" c"'), F.lit(" {}")))
            .otherwise(F.lit("{}")))


def raw_answers(spark: SparkSession, sf_dir: str, key=PHASE_KEYS["before"]) -> DataFrame:
    """(idx, model, text, k, raw): one answer per document."""
    d = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    i = F.col("doc_id")
    return d.select(i.alias("idx"), F.col("source").alias("model"), F.col("text"),
                    variant(key(i), i).cast("bigint").alias("k"),
                    gen_answer(variant(key(i), i), F.col("text"), i).alias("raw"))


# What is put before the last brace of an object to spoil it.
FAULTS = [",", ',"n":NaN', ',"e":"a\\x"', ',"l":[1', ' "m":1', ',"c" 1', ',"v":', ',,"v":1', ',"t":"a\tb"', ",'s':1", ""]


def faulty_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, raw): one object per document, spoilt by the ``idx``-th of ``FAULTS`` in turn (the last leaves it whole)."""
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    i = F.col("doc_id")
    whole = gen_answer(F.lit(0), F.col("text"), i)
    spoil = F.array(*[F.lit(x) for x in FAULTS])[F.pmod(i, F.lit(len(FAULTS))).cast("int")]
    return d.select(i.alias("idx"), F.concat(F.substring(whole, F.lit(1), F.length(whole) - 1), spoil, F.lit("}")).alias("raw"))


def phase_runs(spark: SparkSession, sf_dir: str, phases=("before", "after")) -> DataFrame:
    """(phase, idx, model, text, k, seed, raw) for both phases from one scan of documents.
    ``seed`` is the answer's title, the text's first line.
    """
    d = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    ph = F.explode(F.array(*[F.lit(p) for p in phases])).alias("phase")
    d = d.select(F.col("doc_id").alias("idx"), F.col("source").alias("model"), F.col("text"),
                 F.split(F.col("text"), "\n", 2)[0].alias("seed"))
    d = d.select(ph, "idx", "model", "text", "seed")
    kk = F.when(F.col("phase") == phases[0], PHASE_KEYS[phases[0]](F.col("idx")))
    for p in phases[1:]:
        kk = kk.when(F.col("phase") == p, PHASE_KEYS[p](F.col("idx")))
    d = d.withColumn("k", variant(kk, F.col("idx")).cast("bigint"))
    return d.withColumn("raw", gen_answer(F.col("k"), F.col("text"), F.col("idx")))


def semantic_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, semantic_ok): human verdicts; rows without a verdict are not judged."""
    return table(spark, sf_dir, "labels", "doc_id", "quality").select(
        F.col("doc_id").alias("idx"), (F.col("quality") == 1).alias("semantic_ok"))


# ---- structured rows and free texts for pair building ------------------------------

def gold_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, items ARRAY<STRUCT<n, name, flag>>): line items of each order in line order
    (ties broken by part name, then flag)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    p = table(spark, sf_dir, "part", "p_partkey", "p_name")
    it = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return (it.groupBy(F.col("l_orderkey").alias("id"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("l_linenumber").alias("n"),
                                                      F.col("p_name").alias("name"),
                                                      F.col("l_returnflag").alias("flag")))).alias("items")))


def step_text(x: Column) -> Column:
    """The step of a line item: its text follows from the line number and the flag, which alone are moved."""
    return F.concat(F.lit("Pack line "), x["n"].cast("string"), F.lit(" flag "), x["flag"])


def structured_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, title, ingredients, directions) as strings; list cells as list-literal text."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    g = gold_items(spark, sf_dir)
    r = o.join(g, o.o_orderkey == g.id, "left")
    empty = F.lit("[]")
    return r.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit(" Order "), F.col("o_orderkey").cast("string"), F.lit(" "),
                 F.col("o_orderpriority"), F.lit(" ")).alias("title"),
        F.coalesce(F.to_json(F.transform("items", lambda x: x["name"])), empty).alias("ingredients"),
        F.coalesce(F.to_json(F.transform("items", step_text)), empty).alias("directions"))


def _q(c) -> F.Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def structured_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, line): the structured rows as raw CSV text with known faults.

    id % 13 == 3 -> one extra cell (skipped by the tolerant reader);
    id % 19 == 6 -> two extra cells, the first one empty (skipped);
    id % 23 == 9 -> a quote that never closes (set aside);
    id % 17 == 4 -> only two cells (kept, missing cells null);
    id % 50 == 7 -> ingredients cell is a broken list literal;
    id % 50 == 8 -> ingredients cell ends with a comma and holds None.
    Written with ``write_csv_lines``; the header's first name is empty, as in
    an index-column export.
    """
    s = structured_rows(spark, sf_dir)
    i = F.col("id")
    ing = F.when(i % 50 == 7, F.expr("substring(ingredients, 1, length(ingredients) - 1)")) \
        .when(i % 50 == 8, F.concat(F.regexp_replace("ingredients", r"\]$", ""),
                                    F.when(F.col("ingredients") == "[]", "").otherwise(","), F.lit("None,]"))) \
        .otherwise(F.col("ingredients"))
    full = F.concat_ws(",", i.cast("string"), _q(F.col("title")), _q(ing), _q(F.col("directions")))
    line = (F.when(i % 13 == 3, F.concat(full, F.lit(',"extra"')))
            .when(i % 19 == 6, F.concat(full, F.lit(',,"extra"')))
            .when(i % 23 == 9, F.concat_ws(",", i.cast("string"), F.concat(F.lit('"'), F.col("title")), F.lit("rest")))
            .when(i % 17 == 4, F.concat_ws(",", i.cast("string"), _q(F.col("title"))))
            .otherwise(full))
    return s.select(i.alias("pos"), line.alias("line"))


STRUCT_HEADER = ",title,ingredients,directions"


def write_csv_lines(lines: DataFrame, path: str, header: str) -> str:
    """Write raw CSV text lines with ``header`` as the first line of every part
    file, as a CSV writer does, so a header-aware reader skips it per file.

    Spark's own CSV writer does the work on one column named by the header: a
    separator that never occurs and no quoting keep each line verbatim.  Part files are
    compressed, each as large as one task's share of the lines.
    """
    (lines.select(F.col("line").alias(header)).write.mode("overwrite")
     .option("header", True).option("compression", "lz4").option("sep", "\u0001").option("quote", "")
     .option("escapeQuotes", False).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def tagged_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, line): documents as one tagged text, ``ID n — text`` per record.

    Odd ids use ``iID n - ``; ids with id % 31 == 9 end with words that only look like a
    marker; ids with id % 97 == 5 appear a second time at
    the end of the file with a revised text (the later one must win).
    """
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    i = F.col("doc_id")
    d = d.withColumn("text", F.when(i % 31 == 9, F.concat("text", F.lit(" add acid 5 drops"))).otherwise(F.col("text")))
    mark = F.when(i % 2 == 1, F.concat(F.lit("iID "), i.cast("string"), F.lit(" - "))) \
        .otherwise(F.concat(F.lit("ID "), i.cast("string"), F.lit(" — ")))
    first = d.select(i.alias("pos"), F.concat(mark, F.col("text")).alias("line"))
    again = d.filter(i % 97 == 5).select((i + F.lit(1 << 40)).alias("pos"),
                                         F.concat(mark, F.col("text"), F.lit(" (revised)")).alias("line"))
    return first.unionByName(again)


def write_lines(lines: DataFrame, path: str) -> str:
    """Write (pos, line) as text in ``pos`` order (range partitions -> ordered part files)."""
    lines.orderBy("pos").select("line").write.mode("overwrite").text(path)
    return path


def gold_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, gold): the well-formed object of each document, as a judge would write it.

    Some differ from the answers: another title (i % 7 == 2; wider blanks at 1, which still match),
    the first item missing (i % 4 == 1) or one more (2), the last step missing (i % 6 == 5)."""
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    i = F.col("doc_id")
    title, ing, steps = answer_fields(F.col("text"), i)
    none = F.array().cast("array<string>")
    return d.select(i.alias("idx"),
                    F.struct(F.when(i % 7 == 2, F.concat(title, F.lit(" (gold)"))).when(i % 7 == 1, F.replace(title, F.lit(" "), F.lit("  "))).otherwise(title).alias("title"),
                             F.when(i % 4 == 1, F.slice(ing, 2, F.greatest(F.size(ing), F.lit(1))))
                             .when(i % 4 == 2, F.concat(ing, F.array(F.lit("salt")))).otherwise(ing).alias("ingredients"),
                             F.concat(steps, F.when(i % 6 == 5, none).otherwise(F.array(F.lit("x")))).alias("steps")).alias("gold"))


def stored_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, phase, idx, system, template, limits): the prompt parts kept with every request.

    The system text names the document's language.  Some requests of one phase used
    a changed template (a prompt drift to find).
    """
    ph = F.explode(F.array(F.lit("before"), F.lit("after"))).alias("phase")
    m = table(spark, sf_dir, "documents", "doc_id", "source", "lang").select(
        F.col("source").alias("model"), F.col("doc_id").alias("idx"), "lang", ph)
    tmpl = F.when((F.col("idx") % 29 == 3) & (F.col("phase") == "after"), "chatml-v2").otherwise("chatml")
    return m.select("model", "phase", "idx", F.concat(F.lit("Extract a JSON object. Language: "), F.coalesce("lang", F.lit("?"))).alias("system"),
                    tmpl.alias("template"), F.lit("1200,2000").alias("limits"))
