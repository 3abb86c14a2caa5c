"""Cross-run comparison and audits: missing outputs, before/after status,
scores against gold, input drift, grounding, pivots, field statistics,
prompt fingerprints and ledger reconciliation."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapekit.functions.distance import edit_distance
from shapekit.functions.text import normalise_title

#: cells of a distance table up to which the built-in function is used
SMALL_TABLE = 1 << 14


def missing_outputs(prompts: DataFrame, outputs: DataFrame, keys=("model", "idx")) -> DataFrame:
    """Inputs without a stored result ("Extracted n / N" gap)."""
    return prompts.join(outputs.select(*keys), list(keys), "left_anti")


def compare_runs(a: DataFrame, b: DataFrame, keys=("model", "idx"), ok: str = "ok") -> DataFrame:
    """Per input: fixed / broken / unchanged_ok / unchanged_fail / only_a / only_b."""
    j = (a.select(*keys, F.col(ok).alias("ok_a"))
         .join(b.select(*keys, F.col(ok).alias("ok_b")), list(keys), "full_outer"))
    st = (F.when(F.col("ok_a").isNull(), "only_b").when(F.col("ok_b").isNull(), "only_a")
          .when(~F.col("ok_a") & F.col("ok_b"), "fixed").when(F.col("ok_a") & ~F.col("ok_b"), "broken")
          .when(F.col("ok_a"), "unchanged_ok").otherwise("unchanged_fail"))
    return j.withColumn("status", st)


@F.pandas_udf(T.LongType())
def _edit_distances(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else edit_distance(a, b) for a, b in zip(left, right, strict=True)], dtype="Int64")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _absent(items: pd.Series, text: pd.Series) -> pd.Series:
    """The items that a text does not hold, by one scan of it for all of them."""
    import ahocorasick

    def rest(wanted, low):
        if wanted is None or low is None:
            return None
        search = ahocorasick.Automaton()
        for x in wanted:
            search.add_word(x, x)
        search.make_automaton()
        left = set(wanted)
        for _, x in search.iter(low):
            left.discard(x)
            if not left:
                break
        return sorted(left)
    return pd.Series([rest(i, t) for i, t in zip(items, text, strict=True)], dtype=object)


def score_against_gold(outputs: DataFrame, gold: DataFrame, key: str = "idx",
                       title: str = "title", items: str = "ingredients", steps: str = "steps") -> DataFrame:
    """Semantic scores per input: normalised title match, item-set precision /
    recall / F1, step-list equality and edit distance of the joined steps."""
    o = outputs.select(key, F.col("output").alias("o"))
    g = gold.select(key, F.col("gold").alias("g"))
    j = o.join(g, key, "inner")
    oi, gi = F.array_distinct(F.col("o")[items]), F.array_distinct(F.col("g")[items])
    inter = F.size(F.array_intersect(oi, gi)).cast("double")
    prec = F.when(F.size(oi) > 0, inter / F.size(oi)).otherwise(F.lit(0.0))
    rec = F.when(F.size(gi) > 0, inter / F.size(gi)).otherwise(F.lit(0.0))
    f1 = F.when((prec + rec) > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    # edit distance of the joined steps: the built-in's time grows with the product of the lengths, so longer
    # texts go to a function whose time grows with the differences; equal ones go nowhere
    left, right = F.array_join(F.col("o")[steps], "\n"), F.array_join(F.col("g")[steps], "\n")
    small = F.length(left).cast("long") * F.length(right) <= SMALL_TABLE
    large = ~small & (left != right)
    edit = (F.when(left == right, F.lit(0)).when(small, F.levenshtein(left, right))
            .otherwise(_edit_distances(F.when(large, left), F.when(large, right))))
    return j.select(
        key,
        (normalise_title(F.col("o")[title]) == normalise_title(F.col("g")[title])).alias("title_match"),
        F.round(prec, 6).alias("item_precision"), F.round(rec, 6).alias("item_recall"),
        F.round(f1, 6).alias("item_f1"),
        (F.col("o")[steps] == F.col("g")[steps]).alias("steps_equal"),
        edit.cast("bigint").alias("steps_edit"))


def input_drift(a: DataFrame, b: DataFrame, key: str = "idx", text: str = "text") -> DataFrame:
    """Same key, different input text between two runs (compared by md5)."""
    return (a.select(key, F.md5(F.col(text)).alias("h_a"))
            .join(b.select(key, F.md5(F.col(text)).alias("h_b")), key, "inner")
            .filter(F.col("h_a") != F.col("h_b")))


def grounding(outputs: DataFrame, prompts: DataFrame, keys=("model", "idx"),
              fields=("ingredients",), by=("model",)) -> DataFrame:
    """Share of extracted items found verbatim (case-folded) in the source text."""
    j = outputs.select(*keys, F.flatten(F.array(*[F.col("output")[f] for f in fields])).alias("items")) \
        .join(prompts.select(*keys, F.lower("text").alias("low")), list(keys), "inner")
    # items that are lines of the text are found by hash; the others by one scan of the text for all of them
    low = F.transform("items", lambda x: F.lower(x))
    j = j.withColumn("n", F.size("items")).withColumn("items", F.filter(low, lambda x: x.isNotNull()))
    lines = F.split(F.col("low"), "\n", -1)
    j = j.withColumn("rest", F.array_except("items", F.concat(lines, F.array(F.lit("")))))
    open_ = F.size("rest") > 0
    j = j.withColumn("absent", _absent(F.when(open_, F.col("rest")), F.when(open_, F.col("low"))))
    # absent items as often as they stand in the list
    lost = F.when(open_ & (F.size("absent") > 0), F.size(F.filter("items", lambda x: F.array_contains("absent", x)))).otherwise(0)
    per = j.select(*by, "n", (F.size("items") - lost).alias("f")).filter("n > 0")
    return (per.groupBy(*by).agg(F.sum("n").alias("n_items"), F.sum("f").alias("n_found"))
            .withColumn("share", F.round(F.col("n_found") / F.col("n_items"), 6)))


def phase_pivot(rates: DataFrame, rate: str, phases=("before", "after"), model: str = "model") -> DataFrame:
    """Model rows, one column per phase, the change and the relative error cut."""
    p = rates.groupBy(model).pivot("phase", list(phases)).agg(F.first(rate))
    a, b = F.col(phases[0]), F.col(phases[1])
    cut = F.when((1 - a) > 0, F.round(((1 - a) - (1 - b)) / (1 - a), 6))
    return p.withColumn("delta", F.round(b - a, 6)).withColumn("error_cut", cut)


def field_stats(outputs: DataFrame, by=("model",), title: str = "title",
                lists=("ingredients", "steps")) -> DataFrame:
    """Items per list field, empty titles/lists, distinct and repeated titles."""
    o = outputs.select(*by, F.col("output").alias("o"))
    size = {f: F.size(F.col("o")[f]) for f in lists}
    # one grouping by title, then its few rows per title by group
    t = o.groupBy(*by, F.col("o")[title].alias("t")).agg(
        F.count(F.lit(1)).alias("c"), *[F.sum(size[f]).alias(f"s_{f}") for f in lists],
        *[F.count_if(size[f] == 0).alias(f"e_{f}") for f in lists])
    aggs = [F.sum("c").alias("n"), F.coalesce(F.sum(F.when(F.col("t") == "", F.col("c"))), F.lit(0)).alias("empty_titles"),
            F.count("t").alias("distinct_titles")]
    for f in lists:
        aggs += [F.round(F.sum(f"s_{f}") / F.sum("c"), 6).alias(f"avg_{f}"), F.sum(f"e_{f}").alias(f"empty_{f}")]
    return t.groupBy(*by).agg(*aggs, F.count_if(F.col("c") > 1).alias("repeated_titles"))


def title_overlap(a: DataFrame, b: DataFrame, by=("model",), title: str = "title") -> DataFrame:
    """Distinct normalised titles of run ``a`` also present in run ``b`` (title as fallback key)."""
    ta = a.select(*by, normalise_title(F.col("output")[title]).alias("nt")).distinct()
    tb = b.select(*by, normalise_title(F.col("output")[title]).alias("nt")).distinct()
    n_a = ta.groupBy(*by).agg(F.count(F.lit(1)).alias("titles_a"))
    both = ta.join(tb, [*by, "nt"], "left_semi").groupBy(*by).agg(F.count(F.lit(1)).alias("titles_both"))
    return n_a.join(both, list(by), "left").fillna(0, ["titles_both"])


def match_runs(a: DataFrame, b: DataFrame, key: str = "idx", title: str = "title") -> DataFrame:
    """Rows of two runs paired by key, and those left by title: ``(key_a, key_b, status)``.

    Keys are unique in each run; null keys match nothing.  Rows whose key the other run lacks pair by normalised title if
    it stands once among the rest of either side (``by_title``).  Where both have it and one of them more than once, nothing
    is guessed: each row is told as ``ambiguous``.  Null and blank titles pair nothing (``only_a``, ``only_b``).
    """
    cols = lambda d: d.select(F.col(key).alias("key"), normalise_title(F.col(title)).alias("nt"))
    a, b = cols(a), cols(b)
    by_key = a.join(b, "key", "left_semi").select(F.col("key").alias("key_a"), F.col("key").alias("key_b"), F.lit("by_key").alias("status"))
    rest = (a.join(b, "key", "left_anti").withColumn("side", F.lit("a"))
            .unionByName(b.join(a, "key", "left_anti").withColumn("side", F.lit("b"))))
    in_a, in_b = F.col("side") == "a", F.col("side") == "b"
    # one row per title; a title of a third of all rows is one row too
    seen = rest.filter("nt <> ''").groupBy("nt").agg(
        F.count_if(in_a).alias("n_a"), F.count_if(in_b).alias("n_b"),
        F.min(F.when(in_a, F.col("key"))).alias("key_a"), F.min(F.when(in_b, F.col("key"))).alias("key_b"))
    once = (F.col("n_a") == 1) & (F.col("n_b") == 1)
    by_title = seen.filter(once).select("key_a", "key_b", F.lit("by_title").alias("status"))
    left = rest.join(seen.select("nt", "n_a", "n_b"), "nt", "left").filter(~F.coalesce(once, F.lit(False)))
    status = F.when((F.col("n_a") > 0) & (F.col("n_b") > 0), "ambiguous").when(F.col("side") == "a", "only_a").otherwise("only_b")
    left = left.select(F.when(F.col("side") == "a", F.col("key")).alias("key_a"), F.when(F.col("side") == "b", F.col("key")).alias("key_b"), status.alias("status"))
    return by_key.unionByName(by_title).unionByName(left)


def prompt_fingerprint(prompts: DataFrame, parts=("system", "template", "limits"),
                       by=("model",), run: str = "phase") -> DataFrame:
    """One md5 per run of the prompt parts; count of distinct fingerprints per model."""
    fp = F.md5(F.concat_ws("\u0001", *[F.col(p).cast("string") for p in parts]))
    return (prompts.withColumn("fingerprint", fp)
            .groupBy(*by).agg(F.count_distinct(run).alias("n_runs"),
                              F.count_distinct("fingerprint").alias("n_fingerprints")))


def reconcile_ledger(ledger: DataFrame, stored: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """Ledger against stored failures, both ways, per (phase, model, check).

    Titles count as often as they stand on either side (the n-th listing of a title pairs with its n-th
    stored failure), and checks that only one side knows are kept:

    * ``declared`` (null: the ledger lacks the check), ``listed``, ``stored``: the counts told, listed and stored;
    * ``listed_stored``: pairs; ``listed_unstored``, ``stored_unlisted``: what either side has beyond them;
    * ``listed_again``: listings of a title beyond its first;
    * ``listed_in_results`` (with ``results``): listings of titles that are among the run's stored results;
    * ``count_mismatch``, ``stored_mismatch``: the declared count (none: 0) is not that of the listings, of the stored failures.
    """
    keys = ["phase", "model", "check"]
    title = normalise_title(F.col("title")).alias("nt")
    none = F.lit(0).cast("bigint")
    # one row per title, combined before the shuffle; a header without items has a null title and its count
    told = ledger.groupBy(*keys, title).agg(F.max("declared").cast("bigint").alias("declared"), F.count("title").alias("l"), none.alias("s"))
    held = stored.groupBy(*keys, title).agg(F.lit(None).cast("bigint").alias("declared"), none.alias("l"), F.count("title").alias("s"))
    both = told.unionByName(held).groupBy(*keys, "nt").agg(F.max("declared").alias("declared"), F.sum("l").alias("l"), F.sum("s").alias("s"))
    aggs = [F.max("declared").alias("declared"), F.sum("l").alias("listed"), F.sum("s").alias("stored"),
            F.sum(F.least("l", "s")).alias("listed_stored"), F.sum(F.greatest(F.col("l") - F.col("s"), none)).alias("listed_unstored"),
            F.sum(F.greatest(F.col("s") - F.col("l"), none)).alias("stored_unlisted"),
            F.sum(F.greatest(F.col("l") - 1, none)).alias("listed_again")]
    if results is not None:
        known = results.select("phase", "model", title).filter("nt IS NOT NULL").distinct().withColumn("in_results", F.lit(True))
        both = both.join(known, ["phase", "model", "nt"], "left")
        aggs.append(F.sum(F.when(F.col("in_results"), F.col("l")).otherwise(none)).alias("listed_in_results"))
    given = F.coalesce("declared", none)
    return (both.groupBy(*keys).agg(*aggs).withColumn("count_mismatch", given != F.col("listed"))
            .withColumn("stored_mismatch", given != F.col("stored")))
