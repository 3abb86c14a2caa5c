"""Projections, filters, joins and the report of pair building.

Pair building joins structured rows (id, title, list cells) to free texts by
id, drops black-listed ids and rows whose list cells do not parse, and emits
(id, text, json) where json is the gold object.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapekit.functions.text import strip_ws

# The ids the source scripts exclude from the training slice.
BLACKLIST_IDS = (25, 261, 380, 383, 585, 619, 674, 844, 851, 899, 902, 993, 994, 999)


def rename_if_present(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename the columns that exist; absent names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_present(df: DataFrame, cols) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in cols if c in df.columns])


def keep_only(df: DataFrame, cols) -> DataFrame:
    return df.select(*cols)


def sanitize(df: DataFrame, cols) -> DataFrame:
    """Null -> "" and every value as a string."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols})


def strip_cols(df: DataFrame, cols) -> DataFrame:
    """Strip Unicode white space at both ends (``trim`` only strips blanks)."""
    return df.withColumns({c: strip_ws(F.col(c)) for c in cols})


def profile(df: DataFrame) -> DataFrame:
    """(rows, columns, names): one aggregate, column facts from the schema."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        F.lit(",".join(df.columns)).alias("col_names"))


def slice_rows(df: DataFrame, key: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Rows with lo <= key < hi on an explicit key (pushes down to the scan)."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(key) >= lo)
    if hi is not None:
        cond = cond & (F.col(key) < hi)
    return df.filter(cond)


def id_table(spark: SparkSession, ids, name: str = "id") -> DataFrame:
    return spark.createDataFrame([(int(i),) for i in ids], f"{name} bigint")


def exclude_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Anti join against an id list.  A literal list is tiny and broadcast; a
    list given as a table is left to AQE, which broadcasts it only when its
    measured size is under the threshold."""
    return df.join(ids, key, "left_anti")


# An id list given in code is broadcast while it takes at most this many bytes.
LITERAL_BYTES = 1 << 20


def exclude_literal_ids(df: DataFrame, ids=BLACKLIST_IDS, key: str = "id") -> DataFrame:
    """Anti join against ids given in code; a list too long to broadcast is joined like any table."""
    ids = list(ids)
    t = id_table(df.sparkSession, ids, key)
    return exclude_ids(df, F.broadcast(t) if 8 * len(ids) <= LITERAL_BYTES else t, key)


def require_match(df: DataFrame, texts: DataFrame, key: str = "id") -> DataFrame:
    return df.join(texts.select(key), key, "left_semi")


# A list literal as a script writes it: strings in either quote, side by side they are one,
# None / True / False, numbers; a trailing comma is allowed; nothing may follow the bracket.
_ONE = r"""(?:[uU]?'(?:[^'\\\n]|\\[\s\S])*+'|[uU]?"(?:[^"\\\n]|\\[\s\S])*+")"""
_ITEM = r"(?:" + _ONE + r"(?:\s*+" + _ONE + r")*+|None|True|False|[-+]?(?:\d[\d_]*+(?:\.\d*+)?+|\.\d++)(?:[eE][-+]?\d++)?+)"
LIST_CELL = r"^\s*+\[\s*+(?:" + _ITEM + r"\s*+(?:,\s*+" + _ITEM + r"\s*+)*+,?+\s*+)?+\]\s*+$"
_PIECE = r"\\(?:x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|[0-7]{1,3}|[\s\S])|[^\\]++"
# One-letter escapes.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"', "a": "\x07", "b": "\b", "f": "\f", "v": "\x0b", "\n": ""}


def _unescape(s: F.Column) -> F.Column:
    """The value of a string literal's inside."""
    def one(p):
        mark, rest = F.substring(p, 2, 1), F.substring(p, F.lit(3), F.length(p))
        code = lambda hex_, charset: F.decode(F.unhex(hex_), charset)
        octal = F.lpad(F.conv(F.substring(p, F.lit(2), F.length(p)), 8, 16), 4, "0")
        out = F.when(~p.startswith("\\"), p)
        for k, v in _ESCAPES.items():
            out = out.when(mark == k, F.lit(v))
        return (out.when((mark == "x") & (F.length(p) > 2), code(rest, "ISO-8859-1"))
                .when((mark == "u") & (F.length(p) > 2), code(rest, "UTF-16BE"))
                .when((mark == "U") & (F.length(p) > 2), code(rest, "UTF-32"))
                .when(mark.rlike("^[0-7]"), code(octal, "UTF-16BE"))
                .otherwise(p))
    plain = ~F.contains(s, F.lit("\\"))
    return F.when(plain, s).otherwise(F.array_join(F.transform(F.regexp_extract_all(s, F.lit(_PIECE), 0), one), ""))


def parse_list_cell(c) -> F.Column:
    """List-literal text -> ARRAY<STRING>; null when the whole cell is not one list literal.

    Items are strings (``None`` is null; numbers and truth values keep their spelling).
    Tuples, nested lists and scalars are not lists of items and give null."""
    col = F.col(c) if isinstance(c, str) else c

    def item(x):
        quoted = F.rlike(x, F.lit(r"""^[uU]?['"]"""))
        parts = F.transform(F.regexp_extract_all(x, F.lit(_ONE), 0),
                            lambda q: _unescape(F.regexp_replace(q, r"""(?s)^[uU]?['"]|['"]$""", "")))
        return F.when(quoted, F.array_join(parts, "")).when(x != "None", x)
    return F.when(F.rlike(col, F.lit(LIST_CELL)), F.transform(F.regexp_extract_all(col, F.lit(_ITEM), 0), item))


def build_target_json(title, ingredients, directions, target_key: str = "directions") -> F.Column:
    """The gold object as compact JSON; title stripped, non-ASCII kept, nulls kept."""
    return F.to_json(F.struct(strip_ws(title).alias("title"), ingredients.alias("ingredients"),
                              directions.alias(target_key)), {"ignoreNullFields": "false"})


def _listed(structured: DataFrame, lo, hi, blacklist, key: str) -> tuple[DataFrame, DataFrame]:
    """Structured rows with an integer key and an ``in_range`` flag, and the black-list."""
    s = structured.withColumn(key, F.col(key).try_cast("bigint")).filter(F.col(key).isNotNull())
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (F.col(key) >= lo)
    if hi is not None:
        inside = inside & (F.col(key) < hi)
    if blacklist is None:
        blacklist = F.broadcast(id_table(structured.sparkSession, BLACKLIST_IDS, key))
    return s.withColumn("_in", inside), blacklist.select(key)


def pair_with_text(structured: DataFrame, texts: DataFrame, blacklist: DataFrame | None = None,
                   key: str = "id", target_key: str = "directions", lo=None, hi=None) -> DataFrame:
    """All structured rows with a ``cause`` column: kept rows have cause null.

    Causes: ``out_of_range`` (key outside lo <= key < hi), ``blacklist``, ``no_text``,
    ``unparsable``.  The text join is a left join on the integer id (AQE picks broadcast or
    sort-merge at run time); list cells are parsed only for rows with a text.
    """
    s, bl = _listed(structured, lo, hi, blacklist, key)
    j = (s.join(bl.withColumn("_bl", F.lit(True)), key, "left")
          .join(texts.select(key, F.col("text")), key, "left"))
    early = (F.when(~F.col("_in"), "out_of_range").when(F.col("_bl"), "blacklist")
             .when(F.col("text").isNull(), "no_text"))
    j = j.withColumn("_early", early)
    j = (j.withColumn("_ing", F.when(F.col("_early").isNull(), parse_list_cell("ingredients")))
          .withColumn("_steps", F.when(F.col("_early").isNull(), parse_list_cell("directions"))))
    cause = F.coalesce("_early", F.when(F.col("_ing").isNull() | F.col("_steps").isNull(), "unparsable"))
    return (j.withColumn("cause", cause)
             .withColumn("json", F.when(F.col("cause").isNull(),
                                        build_target_json(F.col("title"), F.col("_ing"), F.col("_steps"),
                                                          target_key)))
             .drop("_bl", "_in", "_early"))


def build_pairs(structured: DataFrame, texts: DataFrame, blacklist: DataFrame | None = None,
                key: str = "id", target_key: str = "directions", lo=None, hi=None) -> DataFrame:
    """(id, text, json) training pairs: range and black-list first, then the text join, then
    each list cell parsed once."""
    s, bl = _listed(structured, lo, hi, blacklist, key)
    j = s.filter("_in").join(bl, key, "left_anti").join(texts.select(key, F.col("text")), key, "inner")
    j = j.withColumn("_ing", parse_list_cell("ingredients")).withColumn("_steps", parse_list_cell("directions"))
    return (j.filter(F.col("_ing").isNotNull() & F.col("_steps").isNotNull())
            .select(key, "text", build_target_json(F.col("title"), F.col("_ing"), F.col("_steps"), target_key).alias("json")))


def removal_report(candidates: DataFrame) -> DataFrame:
    """(cause, n) with 'in_range' and 'removed' totals: one aggregation before dropping.
    Rows out of range are their own cause and count neither as in range nor as removed."""
    c = F.coalesce(F.col("cause"), F.lit("kept"))
    by = candidates.groupBy(c.alias("cause")).agg(F.count(F.lit(1)).alias("n"))
    # the totals re-aggregate the (tiny) per-cause counts; the shuffle is reused
    total = (by.filter(F.col("cause") != "out_of_range").agg(F.sum("n").alias("n"))
             .select(F.lit("in_range").alias("cause"), F.coalesce("n", F.lit(0)).alias("n")))
    removed = (by.filter(~F.col("cause").isin("kept", "out_of_range")).agg(F.sum("n").alias("n"))
               .select(F.lit("removed").alias("cause"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))
    return by.unionByName(total.select("cause", F.col("n").cast("bigint").alias("n"))).unionByName(removed)


def blacklist_hits(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """(id, hit): which excluded ids match a row of ``df`` (ids that hit nothing show up)."""
    present = df.select(key).join(ids.select(key), key, "left_semi").distinct().withColumn("hit", F.lit(True))
    return ids.select(key).distinct().join(present, key, "left").select(
        key, F.coalesce("hit", F.lit(False)).alias("hit"))


class EmptyInputError(ValueError):
    """The input table holds no rows."""


def require_nonempty(df: DataFrame, text: str | None = None) -> DataFrame:
    """Abort on an empty input (one cheap ``isEmpty`` job); with ``text``, add
    ``blank`` marking rows whose text is empty after stripping."""
    if df.isEmpty():
        raise EmptyInputError("input table is empty")
    if text is None:
        return df
    return df.withColumn("blank", F.coalesce(strip_ws(F.col(text)) == "", F.lit(True)))
