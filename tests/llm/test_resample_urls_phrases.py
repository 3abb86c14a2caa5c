"""Importance resampling, URL filter and phrase collocations against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from shapekit.llm import collocations, resample, url_filter
from shapekit.llm.queries import URL_RULES

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


# ---- importance resampling ---------------------------------------------------------------------

def sample_docs(seed=3, n=120):
    rnd = random.Random(seed)
    vocab = ["w%d" % i for i in range(90)] + ["ÄRGER", "Été", "x_y", "日本", "a.b"]
    rows = [(1, None), (2, ""), (3, " \n--\t "), (4, "ONE"), (5, "one two-Three"), (None, " ".join(rnd.choices(vocab, k=30)))]
    rows += [(i, rnd.choice([" ", " . ", "\n"]).join(rnd.choices(vocab, k=rnd.choice([5, 19, 20, 21, 60])))) for i in range(6, n)]
    rows += [(n, " ".join(rnd.choices(vocab, k=30_000))), (7, rows[7][1]), (7, "z " * 25)]
    return rows


def resampled(rows, target, grams, buckets, percent, least, seed):
    def feats(text):
        w = alnum(text)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets
                for k in range(grams[0], grams[1] + 1) for i in range(len(w) - k + 1)], len(w)
    s, t = collections.Counter(), collections.Counter()
    for _, text in rows:
        s.update(feats(text)[0])
    for text in target:
        t.update(feats(text)[0])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in s}
    out = []
    for i, text in rows:
        f, n = feats(text)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("grams,buckets,percent,least", [((1, 1), 10_000, 10, 20), ((1, 3), 500, 35, 20), ((2, 2), 100_000, 100, 1)])
def test_resample(spark, grams, buckets, percent, least):
    rows, target = sample_docs(), [None, "w1 w2 W3", "ärger ÄRGER w4 w5 " * 9, ""]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, score int, `rank.a` string").repartition(5)
    bench = spark.createDataFrame([(x,) for x in target], "text string")
    got = resample.resample(spark, docs, bench, grams, buckets, percent, least).collect()
    assert sorted((tuple(r) for r in got), key=str) == resampled(rows, target, grams, buckets, percent, least, 2024)


def test_resample_edges(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([("a b",)], "text string")
    assert resample.resample(spark, docs, bench).collect() == []
    one = spark.createDataFrame([(5, "a b c " * 10, "k")], "doc_id long, text string, `x.y` string")
    none = spark.createDataFrame([], "text string")
    assert [tuple(r) for r in resample.resample(spark, one, none).collect()] == resampled([(5, "a b c " * 10)], [], (1, 1), 10_000, 10, 20, 2024)
    assert resample.drawn(spark, one, bench, percent=100).collect() == one.collect()


def test_bounded_patterns():
    two = resample.patterns((2, 2))[0]
    assert [m[0] for m in two.finditer(resample.collapsed("A--b  c\u00e9 d!".encode()), overlapped=True)] == [b"a b", "b cé".encode(), "cé d".encode()]


# ---- URL filter --------------------------------------------------------------------------------

def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(ASCII_LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(host, path, rules):
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://example.org", "http://EXAMPLE.org/en/12?x=/es/", "https://a.Example.ORG/es/1", "x://org/", "ftp://notorg/",
        "http://badexample.org/es/3", "http://example.org/es", "http://a.com/fr/x", "http://com/de/1", "http://a.com:80/de/1", "http://b.net#frag/fr/",
        "http://c.com/de/a#b?c", "q?u=http://d.com/fr/1", "http://É.org/ÄÖ/", "http://d.net//a//b/", "http://e.net/" + "s/" * 300, "http://x.com/de/\n1"]


def test_url_rules(spark):
    rows = [(i, u, "h", "v") for i, u in enumerate(URLS)] + [(None, URLS[5], "h", "v"), (5, URLS[5], "h", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, `node.x` string")
    got = {(r.page_id, r.host, r.path, r.rule): r.verdict for r in url_filter.judge(spark, pages, URL_RULES).collect()}
    want = {}
    for i, u, *_ in rows:
        host, path = parts(u)
        rule, verdict = rule_of(host, path, URL_RULES)
        want[(i, host, path, rule)] = verdict or "allow"
    assert got == want
    assert url_filter.judge(spark, pages.limit(0), URL_RULES).collect() == []
    assert {r.verdict for r in url_filter.judge(spark, pages, []).collect()} == {"allow"}


def site():
    """A host with a spam branch, articles by number, slugs, dates and sections; another without labels."""
    rnd, rows = random.Random(9), []
    for i in range(400):
        rows += [(f"http://s.net/promo/{rnd.randrange(10**6)}", True), (f"http://s.net/news/{rnd.randrange(10**6)}", False),
                 (f"http://s.net/sport/{rnd.randrange(10**6)}", False), (f"http://s.net/blog/{2000 + i % 20}/{i % 12 + 1:02d}/post-{i}", False),
                 (f"http://s.net/tag/{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}/feed", False),
                 (f"http://t.net/{i}.html", None)]
    return rows  # six pages in turn


def test_url_templates(spark):
    rows = site()
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string").repartition(7)
    # a third of each kind teaches
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows) if b is not None and i // 6 % 3 == 0], "page_id long, bad boolean")
    got = {r.page_id: r for r in url_filter.judge(spark, pages, [], labels).collect()}
    assert len(got) == len(rows)
    assert all((got[i].verdict == "block") == bool(bad) for i, (_, bad) in enumerate(rows))
    named = {got[i].template for i, (u, _) in enumerate(rows) if u.startswith("http://s.net")}
    assert "/promo/{n}" in named  # differs by its labels
    assert not any(t.startswith(("/news/", "/sport/")) for t in named)  # alike, so one branch
    assert any(re.fullmatch(r"/~[a-z]+/\{n\}/\{n\}/post-\{n\}", t) for t in named) and "/tag/*/feed" in named
    assert {got[i].template for i, (u, _) in enumerate(rows) if u.startswith("http://t.net")} == {"/{n}.html"}


def test_url_similar_branches(spark):
    counts = lambda host, name, n: [(f"http://{host}/{name}/{k}",) for k in range(n)]
    rows = counts("a.net", "en", 60) + counts("a.net", "fr", 50) + [(f"http://a.net/img/x{k}.png/",) for k in range(40)] + [("http://a.net/en/",)]
    pages = spark.createDataFrame([(i, *u) for i, u in enumerate(rows)], "page_id long, url string")
    got = {r.template for r in url_filter.judge(spark, pages, []).collect()}
    assert got == {"/~en/{n}", "/img/x{n}.png", "/~en"}


# ---- phrase collocations -----------------------------------------------------------------------

def phrase_docs(seed=4):
    rnd = random.Random(seed)
    vocab = ["v%d" % i for i in range(14)] + ["É", "日本", "X\u00a0y"]
    rows = [(None, "en"), ("", "en"), (" \t. ", None), ("Alone", "de")]
    for _ in range(150):
        words = rnd.choices(vocab, weights=[30 // (k + 1) + 1 for k in range(len(vocab))], k=rnd.choice([1, 2, 9, 40]))
        if rnd.random() < 0.5:
            words[1:1] = ["New", "york", "City"] if rnd.random() < 0.7 else ["san", "jose"]
        rows.append((rnd.choice([" ", "\t", "  "]).join(w + rnd.choice(["", "", "", ",", ".\n", "\v"]) for w in words), rnd.choice(["en", "en", "de", None])))
    rows += [("la " * 4000, "fr"), rows[-1], rows[-1]]
    return rows


def best_phrases(rows, longest, least, top, covered):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    gone = set()
    for p, a in cand.items():
        lang, w = p[0], p[1:]
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                part = (lang, *w[i:i + k])
                if 100 * a >= covered * f[part]:
                    gone.add(part)
    out = collections.defaultdict(list)
    for p, a in cand.items():
        if p not in gone:
            score, _, left, right = min((1_000_000 * a * a // (f[p[:1 + j]] * f[(p[0], *p[1 + j:])]), j, f[p[:1 + j]], f[(p[0], *p[1 + j:])])
                                        for j in range(1, len(p) - 1))
            out[p[0]].append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, k + 1, t.decode(), -a, left, right, n[lang], -s)
                  for lang, x in out.items() for k, (s, a, t, left, right) in enumerate(sorted(x)[:top]))


@pytest.mark.parametrize("longest,least,top,covered", [(3, 10, 2000, 50), (3, 2, 25, 50), (4, 5, 2000, 70), (2, 3, 7, 50)])
def test_collocations(spark, longest, least, top, covered, monkeypatch):
    monkeypatch.setattr(collocations, "TABLE", 40)
    monkeypatch.setattr(collocations, "WORD_TABLE", 30)
    monkeypatch.setattr(collocations, "PART_BYTES", 2000)
    rows = phrase_docs()
    docs = spark.createDataFrame([(i, *r, 5) for i, r in enumerate(rows)], "doc_id long, text string, lang string, n int").repartition(6)
    got = sorted(tuple(r) for r in collocations.collocations(spark, docs, longest, least, top, covered).collect())
    assert got == best_phrases(rows, longest, least, top, covered)


def test_collocations_empty(spark):
    assert collocations.collocations(spark, spark.createDataFrame([], "text string, lang string")).collect() == []


def test_summary_keeps_frequent_keys():
    """Whatever the order of arrival and however few counters, keys that occur ``least`` times survive."""
    rnd = np.random.default_rng(1)
    for least, counters in [(10, 4), (10, None), (3, 1), (3, None), (25, 10), (25, None)]:
        rows, want, enough = [], set(), 0
        for part in (1, 2):
            keys = part * 10**4 + np.concatenate((np.repeat(np.arange(40), least), np.repeat(np.arange(40, 80), least - 1), np.arange(1000, 5000)))
            want |= set(range(part * 10**4, part * 10**4 + 40))
            enough = max(enough, len(keys) // least + 1)
            rnd.shuffle(keys)
            rows += [(part, collocations.planes(x.astype(np.uint64) << np.uint64(24)), collocations.planes(np.ones(len(x), np.int64))) for x in np.array_split(keys, 300)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + 70], strict=True)], names=["part", "keys", "counts"])
                   for i in range(0, len(rows), 70)]
        got = np.zeros(1 << 13, np.uint8)
        for b in collocations.summarise(least, counters or enough, 16)(iter(batches)):
            for at, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got[at:at + len(raw)] |= np.frombuffer(raw, np.uint8)
        assert collocations._in_map(np.array(sorted(want), np.uint64) << np.uint64(48), got, 16).all()
        assert counters or np.unpackbits(got).sum() <= 2 * enough


def test_hash_partitions():
    edges = collocations._part_edges(7)
    assert len(edges) == 7 and edges[0] == 0 and all(edges[1:] > edges[:-1])


def test_bit_map(spark):
    keys = [0, 1 << 47, -1, 32768 << 47, 32769 << 47, 65535 << 47, 65536 << 47, -(2**63), 2**63 - 1, 123456789 << 20]
    keys = [(k + 2**63) % 2**64 - 2**63 for k in keys]
    held = collocations.bit_map(spark.createDataFrame([(k,) for k in keys], "key long"), 17)
    asked = np.array([*keys, 2 << 47, 40_000 << 47], np.int64).view(np.uint64)
    assert len(held) == 1 << 14 and collocations._in_map(asked, held, 17).tolist() == [True] * len(keys) + [False] * 2


def test_thresholds_are_lowered(spark, monkeypatch):
    """With few phrases tried at first, thresholds go down until nothing left out could be among the first."""
    monkeypatch.setattr(collocations, "TRIED", 1)
    monkeypatch.setattr(collocations, "GROWTH", 2)
    rows = phrase_docs(8)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(tuple(r) for r in collocations.collocations(spark, docs, 3, 3, 6, 30).collect())
    assert got == best_phrases(rows, 3, 3, 6, 30)


@pytest.mark.parametrize("text,lang", [("a b c " * 5, "en"), ("a " * 30, None)])
def test_slots_may_collide(spark, monkeypatch, text, lang):
    monkeypatch.setattr(collocations, "SLOT_BITS", 1)
    docs = spark.createDataFrame([(text, lang), (None, "en")], "text string, lang string")
    assert sorted(tuple(r) for r in collocations.collocations(spark, docs, 3, 2, 5, 101).collect()) == best_phrases([(text, lang)], 3, 2, 5, 101)
