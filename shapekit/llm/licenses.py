"""License scan with ordered signature rules.

The text is folded to words (ASCII lower case) joined by one blank, so every rule is a regex over
words.  Rules are ordered; the order is the priority:

1. identifier lines (``SPDX-License-Identifier: X``),
2. grant sentences of the license texts,
3. references with a verb (``licensed under the X version N``),
4. names with a version, then bare names,
5. the base phrases.

A document runs the rules only if it holds one of the stems that every rule needs, and each
rule only if its own keyword is there.  Of the detections, by start and then widest first, one is
suppressed if a kept detection of the same or higher priority contains its interval.
Base phrases are counted before suppression.  Everything is one projection over
the documents: no shuffle, no Python.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: bytes and characters that separate words, after lower-casing A-Z (class) and before (word)
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Signature(NamedTuple):
    label: str
    regex: str
    keyword: str
    weight: float
    base: bool = False


#: Phrases and labels of the contract.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

#: License label, name as words (regex), identifier as words, versions.
NAMES = (
    ("mit", "(?:mit|expat)", "mit", ()),
    ("apache", "apache(?: software)?", "apache", ("1 0", "1 1", "2 0")),
    ("gpl", "(?:gnu )?(?:gpl|general public)", "gpl", ("1", "2", "3")),
    ("lgpl", "(?:gnu )?(?:lgpl|lesser general public|library general public)", "lgpl", ("2", "2 1", "3")),
    ("agpl", "(?:gnu )?(?:agpl|affero general public)", "agpl", ("1", "3")),
    ("gfdl", "(?:gnu )?(?:gfdl|free documentation)", "gfdl", ("1 1", "1 2", "1 3")),
    ("mpl", "(?:mpl|mozilla public)", "mpl", ("1 0", "1 1", "2 0")),
    ("epl", "(?:epl|eclipse public)", "epl", ("1 0", "2 0")),
    ("cddl", "(?:cddl|common development and distribution)", "cddl", ("1 0", "1 1")),
    ("eupl", "(?:eupl|european union public)", "eupl", ("1 0", "1 1", "1 2")),
    ("cpl", "(?:cpl|common public)", "cpl", ("1 0",)),
    ("osl", "(?:osl|open software)", "osl", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "(?:afl|academic free)", "afl", ("1 1", "2 0", "2 1", "3 0")),
    ("artistic", "artistic", "artistic", ("1 0", "2 0")),
    ("bsl", "(?:bsl|boost software)", "bsl", ("1 0",)),
    ("busl", "business source", "busl", ("1 1",)),
    ("bsd", "(?:berkeley software distribution|(?:(?:new|modified|simplified|original|revised) )?bsd)", "bsd", ("2 clause", "3 clause", "4 clause")),
    ("isc", "isc", "isc", ()),
    ("zlib", "zlib", "zlib", ()),
    ("unlicense", "unlicense", "unlicense", ()),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public)", "wtfpl", ("2",)),
    ("cc-by", "(?:cc by|creative commons attribution)", "cc by", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "(?:cc by sa|creative commons attribution share ?alike)", "cc by sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "(?:cc by nc|creative commons attribution non ?commercial)", "cc by nc", ("2 0", "3 0", "4 0")),
    ("cc-by-nd", "(?:cc by nd|creative commons attribution no ?derivatives)", "cc by nd", ("2 0", "3 0", "4 0")),
    ("cc0", "(?:cc0|creative commons zero)", "cc0", ("1 0",)),
    ("odbl", "(?:odbl|open database)", "odbl", ("1 0",)),
    ("ofl", "(?:sil )?(?:ofl|open font)", "ofl", ("1 0", "1 1")),
    ("python", "(?:python software foundation|psf)", "python", ("2 0",)),
    ("php", "php", "php", ("3 0", "3 01")),
    ("postgresql", "postgresql", "postgresql", ()),
    ("ruby", "ruby", "ruby", ()),
    ("ms-pl", "(?:ms pl|microsoft public)", "ms pl", ()),
    ("ms-rl", "(?:ms rl|microsoft reciprocal)", "ms rl", ()),
    ("sspl", "(?:sspl|server side public)", "sspl", ("1",)),
    ("ncsa", "(?:ncsa|university of illinois)", "ncsa", ()),
    ("openssl", "openssl", "openssl", ()),
    ("x11", "x11", "x11", ()),
    ("w3c", "w3c", "w3c", ()),
    ("upl", "universal permissive", "upl", ("1 0",)),
)

#: Sentences of license texts, as words.
GRANTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "distribute"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "gnu"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "implied"),
    ("public-domain", "(?:released|dedicated|placed) (?:in)?to the public domain", "domain"),
    ("proprietary", "all rights reserved", "reserved"),
    ("proprietary", "(?:proprietary and )?confidential and proprietary", "proprietary"),
)

#: every rule holds one of these, or VERBS and "under"; parts of single words, so that any gap between words may follow
STEMS = ("licen", "spdx", "permission", "redistribution", "unencumbered", "implied", "domain", "reserved", "proprietary", "mozilla")
VERBS = ("released", "distributed", "available")
LICENSE = "licen[cs]es?"


def _keyword(name: str) -> str:
    """A word every match of a name holds, or the blank if it has a choice of words."""
    return " " if "(" in name else f" {name.split(' ')[0]} "


def signatures() -> list[Signature]:
    """All rules in priority order, made from the names, versions and sentence forms above."""
    tiers: list[list[Signature]] = [[], [], [], [], []]
    for label, name, ident, versions in NAMES:
        key = _keyword(name)
        for v in versions:
            full = f"{label}-{v.replace(' ', '.')}"
            tiers[0].append(Signature(full, f"spdx licen[cs]e identifier {ident} {v}(?: only| or later)?", " spdx ", 1.0))
            tiers[2].append(Signature(full, f"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?{name}(?: {LICENSE})?(?: version| v)? ?{v}", " under ", 0.9))
            tiers[3].append(Signature(full, f"{name} {LICENSE}(?: version| v)? {v}", key, 0.8))
        tiers[0].append(Signature(label, f"spdx licen[cs]e identifier {ident}", " spdx ", 1.0))
        tiers[2].append(Signature(label, f"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?{name}(?: {LICENSE})?", " under ", 0.8))
        tiers[3].append(Signature(label, f"{name} {LICENSE}", key, 0.6))
    tiers[1] = [Signature(label, text, f" {key} ", 0.95) for label, text, key in GRANTS]
    tiers[4] = [Signature(label, phrase, f" {phrase} ", 0.5, True) for label, phrase in BASE]
    return [s for t in tiers for s in t]


def _rules(rules: list[Signature]) -> Column:
    """The rules as one constant array."""
    return F.array(*(F.struct(F.lit(k).alias("ord"), F.lit(s.label).alias("label"), F.lit(f" {s.regex}(?= )").alias("regex"),
                              F.lit(s.keyword).alias("keyword"), F.lit(s.weight).alias("weight"), F.lit(s.base).alias("base"))
                     for k, s in enumerate(rules)))


PLACE = "struct<start:int,wide:int,ord:int,stop:int,label:string,weight:double,base:boolean>"


def _places(folded: Column, r: Column) -> Column:
    """All places of a rule as word intervals.  Folded text begins and ends with a blank and a match
    begins with the blank before its first word, so blanks before it number its words."""
    words = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    found = F.regexp_extract_all(folded, r["regex"], F.lit(0))
    between = F.split(folded, r["regex"], -1)
    walked = F.aggregate(
        F.arrays_zip(F.transform(between, words).alias("gap"), F.transform(found, words).alias("len")),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{PLACE}>").alias("out")),
        lambda a, m: F.struct(
            (a["at"] + m["gap"] + F.coalesce(m["len"], F.lit(0))).alias("at"),
            F.when(m["len"].isNotNull(), F.concat(a["out"], F.array(F.struct(
                (a["at"] + m["gap"]).alias("start"), (-m["len"]).alias("wide"), r["ord"].alias("ord"),
                (a["at"] + m["gap"] + m["len"]).alias("stop"), r["label"].alias("label"), r["weight"].alias("weight"), r["base"].alias("base")))))
            .otherwise(a["out"]).alias("out")),
        lambda a: a["out"])
    return F.when(F.rlike(folded, r["regex"]), walked).otherwise(F.array().cast(f"array<{PLACE}>"))


def detect(spark: SparkSession, docs: DataFrame, rules: list[Signature] | None = None) -> DataFrame:
    """``(doc_id, n_words, places, kept)`` for every row of ``docs(doc_id, text)``.

    ``places`` are all detections as structs (start, wide, ord, stop, label, weight, base) in words, by
    start and then widest first; ``kept`` are those that survive suppression.

    Null texts count as empty: no words, no detections.  Repeated rows and null ids are each returned.  Equal
    intervals keep the rule of higher priority.  Empty input: empty result.  Other columns are ignored.
    """
    C.prepare(spark)
    low = F.lower("text")
    holds = lambda *parts: _any([F.contains(low, F.lit(s)) for s in parts])
    # the stems are those of the own rules; other rules go by their keywords alone
    gate = holds(*STEMS) | holds("under") & holds(*VERBS) if rules is None else F.lit(bool(rules)) & F.col("text").isNotNull()
    rules = signatures() if rules is None else rules
    text = F.coalesce("text", F.lit(""))
    gate = F.coalesce(gate, F.lit(False))
    folded = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate("text", UPPER, LOWER), GAP, " ")), F.lit(" "))
    out = docs.select("doc_id", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.when(gate, folded).alias("folded"))
    mine = F.filter(_rules(rules), lambda r: F.contains(F.col("folded"), r["keyword"]))
    places = F.array_sort(F.flatten(F.transform(mine, lambda r: _places(F.col("folded"), r))))
    none = F.array().cast(f"array<{PLACE}>")
    out = out.select("doc_id", "n_words", F.when(F.col("folded").isNotNull(), places).otherwise(none).alias("places"))
    kept = F.aggregate("places", none, lambda a, p: F.when(
        F.exists(a, lambda k: (k["start"] <= p["start"]) & (k["stop"] >= p["stop"]) & (k["ord"] <= p["ord"])), a)
        .otherwise(F.concat(a, F.array(p))))
    return out.select("doc_id", "n_words", "places", kept.alias("kept"))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def license_summary(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Base places with their first and last start, labels, and a score: the best kept rule's weight."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return detect(spark, docs).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(F.transform(base, lambda p: p["label"])).alias("base_labels"),
        joined(F.concat(F.transform(base, lambda p: p["label"]), F.transform("kept", lambda p: p["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda p: p["weight"])), F.lit(0.0)).alias("score"))
