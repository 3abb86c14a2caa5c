"""Every rule of the license scan is reached by the texts it matches."""

import itertools
import re
from re import _constants as K
from re import _parser

from pyspark.sql import functions as F

from shapekit.llm import licenses


def samples(tree):
    """Shortest matches of a regex, one for each choice of alternatives."""
    parts = []
    for op, arg in tree:
        if op is K.LITERAL:
            parts.append([chr(arg)])
        elif op is K.IN:
            parts.append([chr(arg[0][1])])
        elif op is K.SUBPATTERN:
            parts.append(samples(arg[3]))
        elif op is K.BRANCH:
            parts.append([x for a in arg[1] for x in samples(a)])
        else:
            assert op is K.MAX_REPEAT and arg[0] == 0, op
    return ["".join(x) for x in itertools.product(*parts)]


def test_every_rule_passes_the_gate(spark):
    rows = []
    for k, rule in enumerate(licenses.signatures()):
        for text in samples(_parser.parse(rule.regex)):
            assert re.fullmatch(rule.regex, text)
            rows.append((len(rows), k, text.replace(" ", "\r\n * ").upper()))
    assert len({r[1] for r in rows}) == len(licenses.signatures())
    docs = spark.createDataFrame(rows, "doc_id long, ord int, text string").repartition(8)
    found = licenses.detect(spark, docs).select("doc_id", F.transform("places", lambda p: p["ord"]).alias("ords"))
    lost = docs.join(found, "doc_id").where("not array_contains(ords, ord)").select("text").collect()
    assert not lost


def test_references_without_the_word_license(spark):
    texts = ["This code is available under GPL version 3", "Distributed under\nApache 2.0", "released into the public\n  domain", "understood, available"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.license_summary(spark, docs).collect()}
    assert got == {0: ("gpl-3", 0.9), 1: ("apache-2.0", 0.9), 2: ("public-domain", 0.95), 3: ("", 0.0)}


def test_other_rules_go_by_their_keywords(spark):
    docs = spark.createDataFrame([(1, "some beer ware"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: len(r.places) for r in licenses.detect(spark, docs, [licenses.Signature("beer", "beer ware", " beer ", 0.5)]).collect()}
    assert got == {1: 1, 2: 0}
