"""Secret scan gated by a trigram inverted index.

Every rule is a regex.  From its parse tree follow the literal strings a match must
contain, and from those a Boolean trigram query: all clauses must hold, a clause holds if
one of its alternatives has all its trigrams.  The index lists, for each trigram that
any rule asks for, the documents that contain it (ASCII letters folded).  Postings
are intersected per rule; the candidates left are verified with the regex on the
whole text.  A rule without a mandatory trigram (hex runs) scans every document.

Only DataFrame functions run on the data; the derivation works on the rules alone.
"""

from __future__ import annotations

from re import _parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C


class Rule(NamedTuple):
    """A kind of secret.  ``group`` (0: whole match) must have ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


#: Kinds and patterns of the contract, in its order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Published formats of further credentials.
EXTRA = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]{16,}"),
)
RULES = BASE + EXTRA

#: alternatives kept for one literal run; a wider choice ends the run
WIDEST = 32
#: trigrams asked of one literal, spread over it (fewer ask less and still lose no match)
ASKED = 4


def literal_runs(regex: str) -> list[set[str]]:
    """Mandatory parts of a regex: each part is a set of strings of which every match
    contains one (lower case).  Character classes of a few letters and optional
    parts multiply the alternatives; anything wider ends the run."""
    runs: list[set[str]] = []

    def walk(items, open_: set[str]) -> set[str]:
        def end():
            nonlocal open_
            if open_ != {""}:
                runs.append(open_)
            open_ = {""}

        def add(choices: set[str] | None):
            nonlocal open_
            if choices is None or len(open_) * len(choices) > WIDEST:
                end()
                if choices is not None and len(choices) <= WIDEST:
                    open_ = set(choices)
            else:
                open_ = {a + b for a in open_ for b in choices}

        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                add({chr(arg).lower()})
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                add({chr(a).lower() for _, a in arg})
            elif name == "SUBPATTERN":
                open_ = walk(arg[-1], open_)
            elif name == "BRANCH":
                add(_exact(arg[1]))
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                low, high, body = arg
                exact = _exact([body]) if int(high) <= 2 else None
                if exact is None or low == 0 and len(exact) > 1:  # an optional choice tells little
                    end()
                else:
                    add({"".join(p) for n in range(low, int(high) + 1) for p in _power(exact, n)})
            elif name != "AT":
                end()
        return open_

    last = walk(parser.parse(regex), {""})
    if last != {""}:
        runs.append(last)
    return runs


def _power(choices: set[str], n: int) -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = [()]
    for _ in range(n):
        out = [p + (c,) for p in out for c in sorted(choices)]
    return out


def _exact(branches) -> set[str] | None:
    """All strings that a choice of branches can match, if they are few literals."""
    out: set[str] = set()
    for items in branches:
        some = {""}
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                more = {chr(arg).lower()}
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                more = {chr(a).lower() for _, a in arg}
            elif name == "SUBPATTERN":
                more = _exact([arg[-1]])
            elif name == "BRANCH":
                more = _exact(arg[1])
            elif name == "MAX_REPEAT" and int(arg[1]) <= 2:
                body = _exact([arg[2]])
                more = None if body is None else {"".join(p) for n in range(arg[0], int(arg[1]) + 1) for p in _power(body, n)}
            else:
                more = None
            if more is None or len(some) * len(more) > WIDEST:
                return None
            some = {a + b for a in some for b in more}
        out |= some
    return out if len(out) <= WIDEST else None


def trigram_query(regex: str) -> list[list[list[str]]]:
    """Boolean trigram query: clauses of alternatives of trigrams.  No clause: scan fully."""
    clauses = []
    for run in literal_runs(regex):
        if all(len(s) >= 3 for s in run):
            clauses.append(sorted(sorted({s[k:k + 3] for k in _spread(len(s) - 2)}) for s in run))
    return clauses


def _spread(places: int) -> list[int]:
    """At most ``ASKED`` of the places, first and last included."""
    return [k * (places - 1) // (ASKED - 1) for k in range(ASKED)] if places > ASKED else list(range(places))


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """Index rows ``(gram, doc_id)`` of the asked trigrams."""
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams)))
    folded = docs.select("doc_id", F.lower("text").alias("low"))  # a column of its own: folded once, not once a trigram
    # the outer form, since Spark would test an inner one's array in a filter of its own, computed twice over
    return folded.select("doc_id", held.alias("held")).select(F.explode_outer("held").alias("gram"), "doc_id").where("gram is not null")


def candidates(spark: SparkSession, index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(doc_id, rules)``: rules whose trigram query the document's postings satisfy."""
    asked = [(r.kind, c, a, g, len(alt), len(q)) for r in rules for q in [trigram_query(r.regex)]
             for c, clause in enumerate(q) for a, alt in enumerate(clause) for g in alt]
    wanted = F.broadcast(spark.createDataFrame(asked, "rule string, clause int, alt int, gram string, grams int, clauses int"))
    return (index.join(wanted, "gram")
            .groupBy("doc_id", "rule", "clauses", "clause", "alt", "grams").agg(F.count_distinct("gram").alias("have")).where("have = grams")
            .groupBy("doc_id", "rule", "clauses").agg(F.count_distinct("clause").alias("have")).where("have = clauses")
            .groupBy("doc_id").agg(F.collect_set("rule").alias("rules")))


def _spans(rule: Rule, order: int, text: Column, run: Column) -> Column:
    """Leftmost non-overlapping matches as structs (start, order, stop, kind), in code points;
    matches that fail the length test consume their text but are dropped."""
    pattern = F.lit(rule.regex)
    kept = "array<struct<start:int,ord:int,stop:int,kind:string>>"
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, rule.regex, -1)
    tested = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    all_ = F.arrays_zip(F.transform(between, F.length).alias("gap"), F.transform(found, F.length).alias("len"),
                        F.transform(tested, F.length).alias("test"))
    walked = F.aggregate(
        all_, F.struct(F.lit(0).alias("at"), F.array().cast(kept).alias("out")),
        lambda a, m: F.struct(
            (a["at"] + m["gap"] + F.coalesce(m["len"], F.lit(0))).alias("at"),
            F.when(m["test"] >= rule.least, F.concat(a["out"], F.array(F.struct(
                (a["at"] + m["gap"]).alias("start"), F.lit(order).alias("ord"),
                (a["at"] + m["gap"] + m["len"]).alias("stop"), F.lit(rule.kind).alias("kind"))))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"])
    return F.when(run & F.rlike(text, pattern), walked).otherwise(F.array().cast(kept))


def scan(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, spans)`` for every row: ``spans`` has structs (start, ord, stop, kind) of all
    rules by start, then rule order; positions are code points, stop exclusive.

    Null texts count as empty: no spans.  Repeated rows are each returned, a null doc_id
    is one like any other.  Spans of different rules may overlap.  Empty input: empty result.
    Other columns are ignored.
    """
    C.prepare(spark)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    queries = {r.kind: trigram_query(r.regex) for r in rules}
    grams = sorted({g for q in queries.values() for c in q for a in c for g in a})
    if grams:
        index = C.store(spark, postings(docs, grams), "secret-postings", ["gram"])
        picked = candidates(spark, index, rules)
        docs = (docs.alias("d").join(picked.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), "left")
                .select("d.doc_id", "d.text", F.coalesce("c.rules", F.array().cast("array<string>")).alias("rules")))
    else:
        docs = docs.withColumn("rules", F.array().cast("array<string>"))
    each = []
    for k, r in enumerate(rules):
        # short runs of a repeated class cannot pass the test, so the scan asks for the length at once
        fast = r._replace(regex=f"{r.regex[:-1]}{{{r.least},}}", least=1) if r.regex == r"[0-9a-f]+" else r
        run = F.array_contains("rules", r.kind) if queries[r.kind] else F.lit(True)
        each.append(_spans(fast, k, F.col("text"), run))
    return docs.select("doc_id", F.array_sort(F.concat(*each)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def secret_summary(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans as text."""
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    return scan(spark, docs).select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
