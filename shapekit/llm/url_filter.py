"""URL filters: explicit rules first, a path-template tree for the rest.

Each host has a tree of path templates, grown level by level over all its pages:

* **Variable segments** become wildcards: runs of digits and long hexadecimal runs by their shape (``{n}``,
  ``{h}``), as soon as two segments of a place share it, and words of which a place has many and
  none is frequent (``*``).
* **Similar branches** are merged: the words of a place (64 at most that are not rare) go, the most frequent first, to
  the first group whose pages are like theirs by chi-square tests on what follows (end, number, code, mixed, word) and on
  labels (allowed, blocked, none), else they begin one.  ``~news`` stands for all words grouped with ``news``.
* **Purity.**  A template's share of blocked pages among its labelled ones, smoothed by the
  share over all pages, rejects it from ``REJECT`` on.  Templates without enough labels are allowed.

Labels are the verdicts of the rules, or a table of the caller's.  A level is one aggregation by place
and segment, one by place, and joins with one row per key on one side; of these, keys with a thousandth of all rows (a
thousand keys at most) are broadcast, so no task receives a popular host or branch whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: levels of a template; what lies deeper is one wildcard, ``**``
DEPTH = 8
#: words of a place beyond which rare ones (below a 64th of its pages) are variable
MANY, RARE = 32, 64
#: weight of the overall share in a template's purity, and the purity that rejects it
WEIGHT, REJECT = 2.0, 0.8
#: Chi-square at one in a thousand, for 0 to 4 degrees of freedom.
CRITICAL = (0.0, 10.828, 13.816, 16.266, 18.467)
KINDS = 5  # what follows a segment: end, number, code, mixed, word
HEAVY = 1000

Rule = tuple[str, str, str]  # verdict, host, path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as ``struct(verdict, rule)``, else null.  A rule fits its host, all subdomains
    and the paths it begins; equally long rules go by the longer host."""
    cases = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                    F.struct(F.lit(len(h) + len(p)).alias("long"), F.lit(len(h)).alias("host_long"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
             for v, h, p in rules]
    if not cases:
        return F.lit(None).cast("struct<long:int,host_long:int,rule:string,verdict:string>")
    return cases[0] if len(cases) == 1 else F.greatest(*cases)


def shape(segment: Column) -> Column:
    """A segment with hexadecimal codes and runs of digits as wildcards."""
    codes = F.regexp_replace(segment, "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|(?<![0-9a-zA-Z])(?=[a-fA-F]*[0-9])[0-9a-fA-F]{16,}(?![0-9a-zA-Z])", "{h}")
    return F.regexp_replace(codes, "[0-9]+", "{n}")


def _kind(segment: Column) -> Column:
    """What follows: 0 nothing, 1 a number, 2 a code, 3 text with a number, 4 a word."""
    s = shape(segment)
    return F.when(segment.isNull(), 0).when(s == "{n}", 1).when(s.contains("{h}"), 2).when(s.contains("{n}"), 3).otherwise(4)


def by_key(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key and in ``count`` how many of the ``total`` rows
    hold it.  Keys with a thousandth of the rows are broadcast, the others joined by shuffle."""
    value = F.struct(*[c for c in table.columns if c not in keys]).alias("_v")
    heavy = F.col(count) * HEAVY >= total  # at most HEAVY keys
    first = rows.join(F.broadcast(table.where(heavy).select(*keys, value)), keys, "left")
    light = first.where("_v IS NULL").drop("_v").join(table.where(~heavy).select(*keys, value), keys)
    return first.where("_v IS NOT NULL").unionByName(light).select(*rows.columns, "_v.*")


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two rows of counts may come from one distribution, by chi-square."""
    both = a + b
    a, b, both = a[both > 0], b[both > 0], both[both > 0]
    n, m = a.sum(), b.sum()
    if not n or not m:
        return True
    return float(((a * m - b * n) ** 2 / both).sum() / (n * m)) <= CRITICAL[len(both) - 1]


def _grouped(pdf: pd.DataFrame) -> pd.DataFrame:
    """Words of one place and the group each belongs to."""
    pdf = pdf.sort_values(["n", "name"], ascending=[False, True])
    follows = pdf[[f"k{i}" for i in range(KINDS)]].to_numpy(float)
    labels = np.stack([pdf["good"], pdf["bad"], pdf["n"] - pdf["good"] - pdf["bad"]], 1).astype(float)
    groups: list = []  # [pooled counts of what follows, of labels, members]
    for k in range(len(pdf)):
        group = next((g for g in groups if alike(follows[k], g[0]) and alike(labels[k], g[1])), None)
        if group:
            group[0], group[1] = group[0] + follows[k], group[1] + labels[k]
            group[2].append(k)
        else:
            groups.append([follows[k], labels[k], [k]])
    names = pdf["name"].to_numpy()
    label = np.empty(len(pdf), object)
    for *_, members in groups:
        label[members] = names[members[0]] if len(members) == 1 else "~" + names[members[0]]
    return pdf[["host", "node", "name"]].assign(label=label)


def _level(spark: SparkSession, rows: DataFrame, depth: int) -> DataFrame:
    """Extend the template (``node``) of each row that has a segment at ``depth``."""
    here, sums = F.col("segs")[depth], [f"k{i}" for i in range(KINDS)]
    alive = rows.where(F.size("segs") > depth).withColumn("name", shape(here))
    follows = _kind(F.when(F.size("segs") > depth + 1, F.col("segs")[depth + 1]))
    found = C.store(spark, alive.withColumn("follows", follows).groupBy("host", "node", "name").agg(
        F.count("*").alias("n"), F.min(here).alias("lo"), F.max(here).alias("hi"), F.sum("good").alias("good"), F.sum("bad").alias("bad"),
        *[F.count_if(F.col("follows") == i).alias(k) for i, k in enumerate(sums)]), "url-branches")
    total, branches = found.agg(F.sum("n"), F.count("*")).first()
    places = found.groupBy("host", "node").agg(F.count("*").alias("children"), F.sum("n").alias("all_n"))
    known = C.store(spark, by_key(found, places, ["host", "node"], "children", branches), "url-places")
    variable = F.col("name").contains("{")
    rare = (F.col("children") > MANY) & (F.col("n") * RARE < F.col("all_n"))
    # at most RARE words a place, whatever its size
    words = known.where(~variable & ~rare & (F.col("children") > 1)).select("host", "node", "name", "n", "good", "bad", *sums)
    grouped = words.groupBy("host", "node").applyInPandas(_grouped, "host string, node string, name string, label string")
    label = (F.when(variable, F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("name"))).when(rare, "*")
             .otherwise(F.coalesce("label", "name")))
    named = C.store(spark, known.join(grouped, ["host", "node", "name"], "left").select("host", "node", "name", "n", label.alias("label")), "url-labels")
    longer = by_key(alive, named, ["host", "node", "name"], "n", total)
    done = F.when(F.size("segs") > depth + 1, F.lit("/**" if depth + 1 == DEPTH else "")).otherwise("")
    longer = longer.withColumn("node", F.concat("node", F.lit("/"), "label", done)).select(rows.columns)
    return C.store(spark, longer.unionByName(rows.where(F.size("segs") <= depth)), "url-rows")


def templates(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows(host, segs, node, good, bad)`` with ``node`` grown to the template of the row's path."""
    rows = C.store(spark, rows, "url-rows")
    deepest = rows.agg(F.max(F.size("segs"))).first()[0] or 0
    for depth in range(min(deepest, DEPTH)):
        rows = _level(spark, rows, depth)
    return rows


def judge(spark: SparkSession, pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` for every row of ``pages(page_id, url)``.

    ``rules`` is a bounded list of (verdict, host, path).  ``labels(page_id, bad)``, one row per page, teaches the
    templates; without it the pages that have a rule do.  ``template`` is what a page's host and path fall
    under, ``purity`` its smoothed share of blocked pages; they decide only where no rule fits.

    Null urls and urls without ``://``: empty host and path, no rule, allowed by default (they share one
    template).  Repeated rows are judged alike and each returned; null page_ids are passed on
    and take no label from a table.  Paths deeper than ``DEPTH`` end in ``**``.  No labels at all: all templates are allowed.  Empty input: empty result.
    Other columns are ignored.
    """
    C.prepare(spark)
    host, path = split_url(F.col("url").cast("string"))
    base = pages.select(F.col("page_id").alias("page_id"), host.alias("host"), path.alias("path"))
    base = base.withColumn("found", ruled(F.col("host"), F.col("path"), rules))
    if labels is None:
        base = base.withColumn("is_bad", F.col("found.verdict") == "block")
    else:
        told = labels.select("page_id", F.col("bad").cast("boolean").alias("is_bad")).groupBy("page_id").agg(F.bool_or("is_bad").alias("is_bad"))
        base = base.join(told, "page_id", "left")
    segs = F.split(F.regexp_replace(F.regexp_replace("path", r"\A/", ""), r"/\z", ""), "/")
    segs = F.when(F.col("path").isin("", "/"), F.array().cast("array<string>")).otherwise(segs)
    none = F.lit("")
    rows = base.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"), segs.alias("segs"),
                       none.alias("node"), F.coalesce((~F.col("is_bad")).cast("long"), F.lit(0)).alias("good"),
                       F.coalesce(F.col("is_bad").cast("long"), F.lit(0)).alias("bad"))
    rows = templates(spark, rows)
    counts = C.store(spark, rows.groupBy("host", "node").agg(F.count("*").alias("n"), F.sum("good").alias("g"), F.sum("bad").alias("b")), "url-templates")
    total, good, bad = counts.agg(F.sum("n"), F.sum("g"), F.sum("b")).first()
    prior = (bad or 0) / max((good or 0) + (bad or 0), 1)
    purity = (F.col("b") + F.lit(WEIGHT * prior)) / (F.col("g") + F.col("b") + F.lit(WEIGHT))
    known = by_key(rows, counts.select("host", "node", "n", purity.alias("purity")), ["host", "node"], "n", total or 0)
    verdict = F.coalesce("ruled", F.when((F.col("purity") >= REJECT) & (F.col("host") != ""), "block").otherwise("allow"))
    return known.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("node").alias("template"), "purity")
