"""Language identification by hierarchical discrimination.

A linear classifier names the language family; inside the family, one-versus-one
linear support vector machines tell the languages apart.  Features are hashed counts of
byte 1- to 4-grams of the whole text (ASCII letters folded, runs of other ASCII bytes as one blank), square-rooted
and scaled to length one.

Training reads a bounded sample of labelled documents (about ``PER_LANGUAGE`` of each
language, chosen by hash among those not held out).  Every language is learned, however many there are:
families and pairs of languages are dealt over tasks, ``FAMILIES_A_TASK`` and ``PAIRS_A_TASK`` to each, so a
few languages are one task.  Scoring is one pass over the documents.
"""

from __future__ import annotations

import itertools
import tempfile
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

PER_LANGUAGE = 300
#: weights fitted by one training task
FAMILIES_A_TASK = 32
PAIRS_A_TASK = 256
#: feature rows a training task holds in memory; more are in a temporary file
HELD_ROWS = 16384
FEATURES = 4096
GRAMS = (1, 2, 3, 4)
FOLDS = 5
EPOCHS = 300
LAMBDA = 1e-3
STEP_DOCS = 128
UNKNOWN = "und"

#: Language families by ISO 639-1 code; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga cy br gd",
    "turkic": "tr az kk uz ky tk",
    "indo-aryan": "hi bn ur pa mr gu ne",
    "semitic": "ar he am mt",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

_U = np.uint64


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of gram features per document of a step."""
    docs = len(off) - 1
    out = np.zeros((docs, FEATURES), np.float32)
    b = _FOLD[data]
    doc = np.repeat(np.arange(docs), np.diff(off))
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32) | (doc[1:] != doc[:-1])
    b, doc = b[keep].astype(np.uint64), doc[keep]
    code = np.zeros(len(b), np.uint64)
    for n in GRAMS:
        if len(b) < n:
            break
        code = (code[:len(b) - n + 1] << _U(8)) | b[n - 1:]
        inside = doc[n - 1:] == doc[:len(b) - n + 1]
        cell = (C.mix(code + _U(n << 40)) % _U(FEATURES)).astype(np.int64)[inside]
        out += np.bincount(doc[:len(b) - n + 1][inside] * FEATURES + cell, minlength=docs * FEATURES).reshape(docs, FEATURES)
        # next round extends each start by one byte
    out = np.sqrt(out)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-12)


def svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Linear SVMs (hinge loss, L2) of the columns of ``y``, weights with the bias last in each row; averaged
    full-batch subgradient steps from zero, each class with equal weight."""
    share = np.where(y > 0, 0.5 / np.maximum((y > 0).sum(0), 1), 0.5 / np.maximum((y < 0).sum(0), 1)).astype(np.float32)
    y = y.astype(np.float32)
    w = np.zeros((x.shape[1] + 1, y.shape[1]))
    total = np.zeros_like(w)
    for t in range(1, EPOCHS + 1):
        step = np.zeros_like(w)
        low = w[:-1].astype(np.float32)
        for i in range(0, len(x), HELD_ROWS):
            j = i + HELD_ROWS
            push = np.where(y[i:j] * (x[i:j] @ low + w[-1]) < 1, share[i:j] * y[i:j], np.float32(0))
            step[:-1] += x[i:j].T @ push
            step[-1] += push.sum(0)
        w = w - (LAMBDA * w - step) / (LAMBDA * (t + 10))
        w = w / np.maximum(np.sqrt((w * w).sum(0)) * np.sqrt(LAMBDA), 1)
        if t > EPOCHS // 2:
            total += w
    return (total / (EPOCHS - EPOCHS // 2)).T


def fit(x: np.ndarray, langs: list[str], families: Iterable[str], pairs: Iterable[tuple[str, str]]):
    """``(a, b, weights)`` of the families (b null) and pairs named, as far as there are rows of them."""
    lang = sorted(set(langs))
    place = {v: k for k, v in enumerate(lang)}
    of = np.array([place[v] for v in langs])
    fam = np.array([family(v) for v in lang], object)
    mine = sorted(set(families) & set(fam))
    if mine:
        y = np.stack([np.where((fam == f)[of], 1, -1).astype(np.int8) for f in mine], 1)
        for f, w in zip(mine, svm(x, y), strict=True):
            yield f, None, w
    for a, b in pairs:
        if a in place and b in place:
            rows = np.flatnonzero((of == place[a]) | (of == place[b]))
            yield a, b, svm(x[rows], np.where(of[rows] == place[a], 1, -1)[:, None])[0]


class Model:
    """Family weights (one against the rest) and one-versus-one weights within each family."""

    def __init__(self, langs: Iterable[str], weights: dict[tuple[str, str | None], np.ndarray]):
        langs = sorted(set(langs))
        self.families = sorted({family(v) for v in langs})
        self.members: dict[str, list[str]] = {f: [] for f in self.families}
        for v in langs:
            self.members[family(v)].append(v)
        self.top = np.stack([weights[f, None] for f in self.families]) if len(self.families) > 1 else np.zeros((len(self.families), FEATURES + 1))
        self.pairs = {(family(a), a, b): w for (a, b), w in weights.items() if b is not None}

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        near = x @ self.top[:, :-1].T + self.top[:, -1]
        fam = near.argmax(1)
        sure = np.exp(2 * (near - near.max(1, keepdims=True)))
        sure = 1 / sure.sum(1)
        out = np.empty(len(x), object)
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(fam == k)
            members = self.members[f]
            votes = np.zeros((len(rows), len(members)))
            for i, a in enumerate(members):
                for j in range(i + 1, len(members)):
                    w = self.pairs[f, a, members[j]]
                    p = 1 / (1 + np.exp(-2 * (x[rows] @ w[:-1] + w[-1])))
                    votes[:, i] += (p >= 0.5) + p * 1e-3
                    votes[:, j] += (p < 0.5) + (1 - p) * 1e-3
                    sure[rows] *= np.maximum(p, 1 - p) ** (1 / max(1, len(members) - 1))
            out[rows] = np.array(members, object)[votes.argmax(1)]
        return out.tolist(), np.clip(sure, 0, 1)


def _steps(col: pa.Array):
    for i, j, data, off in C.text_steps(col):
        for a in range(i, j, STEP_DOCS):
            b = min(a + STEP_DOCS, j)
            yield a, b, data[off[a - i]:off[b - i]], off[a - i:b - i + 1] - off[a - i]


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each document has a letter of any script."""
    letter = np.concatenate((np.zeros(1, np.int64), np.cumsum(_LETTER[data])))
    out = letter[off[1:]] > letter[off[:-1]]
    raw = None
    for k in np.flatnonzero(~out):
        raw = data.tobytes() if raw is None else raw
        out[k] = any(c.isalpha() for c in raw[off[k]:off[k + 1]].decode("utf-8", "replace"))
    return out


_LETTER = np.zeros(256, np.int64)
_LETTER[65:91] = _LETTER[97:123] = 1


def _languages(model: Model, col: pa.Array):
    """``(languages, scores, first, last)`` of each step of a text column."""
    for a, b, data, off in _steps(col):
        langs, score = model.predict(features(data, off))
        known = has_letter(data, off)
        yield [v if k else UNKNOWN for v, k in zip(langs, known, strict=True)], np.where(known, score, 0.0), a, b


def _predict(held):
    def run(batches):
        model = held.value
        for batch in batches:
            for langs, score, a, b in _languages(model, C.column(batch, "text")):
                cols = [batch.column(k).slice(a, b - a) for k in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(langs, pa.string()), pa.array(score)], names=[*batch.schema.names, "lang_pred", "score"])
    return run


def held_out(doc_id: Column) -> Column:
    """A fixed fifth of the documents, by id; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` labelled documents of each language that are not held out
    and have a letter."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    count = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not count:
        return Model([], {})
    of: dict[str, list[str]] = {}
    for v in sorted(count):
        of.setdefault(family(v), []).append(v)
    families = sorted(of)
    pairs = [(a, b) for f in families for i, a in enumerate(of[f]) for b in of[f][i + 1:]]
    cut = lambda v, n: [v[i:i + n] for i in range(0, len(v), n)]
    if len(families) <= FAMILIES_A_TASK and len(pairs) <= PAIRS_A_TASK:
        jobs = [(families, pairs)]
    else:  # the families first, then the pairs; a family's task reads all languages, a pair's task its own
        jobs = [(f, []) for f in cut(families, FAMILIES_A_TASK)] + [([], p) for p in cut(pairs, PAIRS_A_TASK)]
    wide = [k for k, (f, _) in enumerate(jobs) if f]
    needs = {v: set(wide) for v in count}
    for k, (_, p) in enumerate(jobs):
        for pair in p:
            for v in pair:
                needs[v].add(k)
    place = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 20))
    plan = spark.createDataFrame([(v, min(1 << 20, max(1, (per_language << 20) // n)), sorted(needs[v])) for v, n in count.items()],
                                 "lang string, share long, job array<int>")
    sample = (labelled.select("doc_id", "text", "lang").join(F.broadcast(plan), "lang").where(place < F.col("share"))
              .select(F.explode("job").alias("job"), "doc_id", "text", "lang"))
    held = spark.sparkContext.broadcast(jobs)

    def learn(k, steps):
        with tempfile.TemporaryFile() as file:
            langs, x, rows = [], [], 0
            for names, part in steps:
                langs += names
                x.append(part)
                rows += len(part)
                if rows > HELD_ROWS and sum(map(len, x)) >= HELD_ROWS:
                    file.write(np.concatenate(x).tobytes())
                    x = []
            if not langs:
                return
            if rows > HELD_ROWS:
                file.write(b"".join(v.tobytes() for v in x))
                file.flush()
                x = np.memmap(file, np.float32, "r", shape=(rows, FEATURES))
            else:
                x = np.concatenate(x)
            # a language with rows has a line of its own, so that the model has no other
            for v in sorted(set(langs)) if k == 0 else ():
                yield v, "", np.zeros(0)
            yield from fit(x, langs, *held.value[k])

    def run(batches):
        def steps():
            for batch in batches:
                job, names = C.int64(C.column(batch, "job")), C.column(batch, "lang").to_pylist()
                starts = [0, *(np.flatnonzero(np.diff(job)) + 1).tolist(), len(job)]
                for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                    for i, j, data, off in _steps(C.column(batch, "text").slice(lo, hi - lo)):
                        ok = has_letter(data, off)
                        yield int(job[lo]), ([v for v, k in zip(names[lo + i:lo + j], ok, strict=True) if k], features(data, off)[ok])

        for k, parts in itertools.groupby(steps(), lambda s: s[0]):
            for a, b, w in learn(k, (s[1] for s in parts)):
                yield pa.RecordBatch.from_arrays([pa.array([a]), pa.array([b], pa.string()), pa.array([w.astype(np.float64).tobytes()], pa.binary())], names=["a", "b", "w"])

    dealt = sample.repartition(1) if len(jobs) == 1 else sample.repartition(4 * len(jobs), "job")
    fitted = dealt.sortWithinPartitions("job", "doc_id", "text", "lang").mapInArrow(run, "a string, b string, w binary").collect()
    return Model([r["a"] for r in fitted if r["b"] == ""], {(r["a"], r["b"]): np.frombuffer(r["w"]) for r in fitted if r["b"] != ""})


def known_language(spark: SparkSession, docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` that are not ``und``, all columns unchanged, in one pass.  With nothing to
    learn from, the rows whose text holds a letter."""
    C.prepare(spark)
    held = spark.sparkContext.broadcast(train(spark, docs) if model is None else model)

    def run(batches):
        for batch in batches:
            text = C.column(batch, "text")
            if held.value.families:
                known = [np.array([v != UNKNOWN for v in langs], bool) for langs, _, _, _ in _languages(held.value, text)]
            else:
                known = [has_letter(data, off) for _, _, data, off in _steps(text)]
            yield batch.filter(pa.array(np.concatenate(known) if known else [], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def identify(spark: SparkSession, docs: DataFrame, model: Model | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` rows with ``lang_pred`` and ``score`` (0 to 1): ``(doc_id, *keep, lang_pred, score)``.

    Texts that are null or hold no letter are ``und`` with score 0.  Languages, ids and
    sources are no inputs of a prediction.  Rows without a label or id are predicted, not learned from.
    Repeated rows are each returned.  With nothing to learn from, all are ``und``.
    """
    C.prepare(spark)
    model = train(spark, docs) if model is None else model
    held = spark.sparkContext.broadcast(model)
    rows = docs.select("doc_id", *(c for c in keep if c != "text"), "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    out = rows.mapInArrow(_predict(held), f"{schema}, lang_pred string, score double")
    return out if "text" in keep else out.drop("text")


def language_summary(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return identify(spark, docs.select("doc_id", "text", "lang")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
