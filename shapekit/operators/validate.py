"""Validation of raw model answers (strict, lenient, api), quarantine split,
inline error records and attempt selection.

Each validator works in staged projections over named columns: the cleaned
text and JSON block first, then one parse of the block into a VARIANT, then
every flag from that VARIANT.  Intermediate columns are dropped at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapekit.functions import jsonx, text
from shapekit.functions.jsonfault import json_fault
from shapekit.functions.jsonx import DEFAULT_SPEC, OutputSpec

STRICT, LENIENT, API = "strict", "lenient", "api"


def seal(df: DataFrame, base_cols=None, outputs=None) -> DataFrame:
    """Optimizer boundary after a staged validation.

    A filter on a validation flag (``ok``) would otherwise be pushed down
    through every staged projection, and alias substitution copies each shared
    sub-expression once per reference; the one-row ``inline`` keeps such
    filters above the finished columns.  Columns cannot be pruned through the
    boundary, so only the requested ``outputs`` (plus the input columns) pass;
    the expressions of the others are never evaluated.
    """
    if outputs is not None:
        keep = list(base_cols or []) + [c for c in outputs if c not in (base_cols or [])]
        df = df.select(*[F.col(f"`{c}`") for c in keep])
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def _told(reason: str = "reason", block: str = "json_str"):
    """The reason with the parser's detail after a colon: ``invalid_json: trailing comma at 57``."""
    return F.when(F.col(reason) == "invalid_json", F.concat(F.col(reason), F.lit(": "), json_fault(F.col(block)))).otherwise(F.col(reason))


def _block_and_parse(df: DataFrame, raw: str) -> DataFrame:
    d = text.with_json_block(df, raw, "json_str", clean="_clean")
    d = d.withColumn("_v", F.try_parse_json(F.col("json_str")))
    return d.withColumn("_keys", F.when(F.col("_v").isNotNull(), F.json_object_keys(F.col("json_str"))))


def validate_strict(df: DataFrame, raw: str = "raw", spec: OutputSpec = DEFAULT_SPEC,
                    outputs=None) -> DataFrame:
    """Adds ``json_str, reason, reason_text, detail, ok, output, missing_keys, extra_keys``
    (or only the names in ``outputs``).  ``reason_text`` tells of ``invalid_json`` also what is wrong, and where in ``json_str``."""
    d = _block_and_parse(df, raw)
    req = F.array(*[F.lit(k) for k in spec.required_keys])
    reason = (F.when(F.col("json_str").isNull(), "no_json")
              .when(F.col("_v").isNull(), "invalid_json")
              .when(F.sort_array(F.array_distinct(F.col("_keys"))) != req, "bad_keys"))
    d = (d.withColumn("reason", reason)
          .withColumn("detail", text.block_detail(F.col("_clean"), F.col("json_str"), already_clean=True))
          .withColumn("reason_text", _told())
          .withColumn("ok", F.col("reason").isNull())
          .withColumn("output", F.when(F.col("ok"), jsonx.strict_output(F.col("_v"), spec)))
          .withColumn("_diff", F.when(F.col("_v").isNotNull(), jsonx.key_diff(F.col("_keys"), spec))))
    return seal(d.withColumn("missing_keys", F.col("_diff.missing"))
                .withColumn("extra_keys", F.col("_diff.extra"))
                .drop("_v", "_keys", "_clean", "_diff"), df.columns, outputs)


def validate_lenient(df: DataFrame, raw: str = "raw", spec: OutputSpec = DEFAULT_SPEC,
                     outputs=None) -> DataFrame:
    """Adds ``json_str, reason, reason_text, detail, ok, output, is_vacuous`` (or ``outputs``).

    ``reason_text`` tells of ``invalid_json`` also what is wrong, and where in ``json_str``.  ``{}`` passes with all defaults, as in the scripts; ``is_vacuous`` marks it.
    """
    d = _block_and_parse(df, raw)
    d = jsonx.with_lenient_fields(d, "_v", "_keys", spec)
    reason = (F.when(F.col("json_str").isNull(), "no_json")
              .when(F.col("_v").isNull(), "invalid_json")
              .when(~F.col("_type_ok"), "bad_types"))
    d = (d.withColumn("reason", reason)
          .withColumn("detail", text.block_detail(F.col("_clean"), F.col("json_str"), already_clean=True))
          .withColumn("reason_text", _told())
          .withColumn("ok", F.col("reason").isNull())
          .withColumn("output", F.when(F.col("ok"), F.col("_out"))))
    vac = F.col("output")[spec.title_field] == ""
    for f in spec.list_fields:
        vac = vac & (F.size(F.col("output")[f]) == 0)
    return seal(d.withColumn("is_vacuous", F.coalesce(vac, F.lit(False)))
                .drop("_v", "_keys", "_clean", "_out", "_type_ok", *jsonx.lenient_tmp_cols(spec)),
                df.columns, outputs)


def validate_api(df: DataFrame, raw: str = "raw", spec: OutputSpec = DEFAULT_SPEC,
                 parity: bool = False, outputs=None) -> DataFrame:
    """Adds ``json_str, reason, ok, output, coerced`` (or ``outputs``), the hosted-model answer rules.

    The whole stripped answer is tried first, then the slice from the first
    ``{`` to the last ``}``; the value must be an object.  Lists are coerced
    (strings become one-element lists unless ``parity``).
    """
    d = df.withColumn("_t", text.strip_ws(F.coalesce(F.col(raw), F.lit(""))))
    d = text.with_json_block(d, "_t", "_wb", already_clean=True)
    d = d.withColumn("_s", text.outer_brace_slice(F.col("_t")))
    d = text.with_json_block(d, "_s", "_sb", already_clean=True)
    d = jsonx.with_api_fields(d, "_t", "_wb", "_s", "_sb", spec, parity)
    d = (d.withColumn("ok", F.col("reason").isNull())
          .withColumn("json_str", F.when(F.col("_wb") == F.col("_t"), F.col("_t")).otherwise(F.col("_s")))
          .withColumn("output", F.when(F.col("ok"), F.col("_out")))
          .withColumn("coerced", F.when(F.col("ok"), F.col("_coerced"))))
    return seal(d.drop("_t", "_wb", "_s", "_sb", "_out", "_coerced", *jsonx.api_tmp_cols(spec)),
                df.columns, outputs)


def validate_reasons(df: DataFrame, raw: str = "raw", spec: OutputSpec = DEFAULT_SPEC,
                     modes=(STRICT, LENIENT)) -> DataFrame:
    """Adds ``<mode>_reason`` for the strict and/or lenient rules in one pass:
    the fence strip, block search and parse are shared, not repeated per mode."""
    d = _block_and_parse(df, raw)
    out = []
    if STRICT in modes:
        req = F.array(*[F.lit(k) for k in spec.required_keys])
        d = d.withColumn("strict_reason", F.when(F.col("json_str").isNull(), "no_json")
                         .when(F.col("_v").isNull(), "invalid_json")
                         .when(F.sort_array(F.array_distinct(F.col("_keys"))) != req, "bad_keys"))
        out.append("strict_reason")
    if LENIENT in modes:
        d = jsonx.with_lenient_fields(d, "_v", "_keys", spec)
        d = d.withColumn("lenient_reason", F.when(F.col("json_str").isNull(), "no_json")
                         .when(F.col("_v").isNull(), "invalid_json")
                         .when(~F.col("_type_ok"), "bad_types"))
        out.append("lenient_reason")
    return seal(d, df.columns, out)


def validate(df: DataFrame, mode: str, raw: str = "raw", spec: OutputSpec = DEFAULT_SPEC,
             outputs=None, **kw) -> DataFrame:
    if mode == STRICT:
        return validate_strict(df, raw, spec, outputs=outputs)
    if mode == LENIENT:
        return validate_lenient(df, raw, spec, outputs=outputs)
    if mode == API:
        return validate_api(df, raw, spec, outputs=outputs, **kw)
    raise ValueError(f"unknown mode {mode!r}")


def split_quarantine(df: DataFrame, ok: str = "ok"):
    """(good rows, failed rows) of one validated table: two filters, one plan."""
    return df.filter(F.col(ok)), df.filter(~F.col(ok))


def inline_errors(df: DataFrame, idx: str = "idx", spec: OutputSpec = DEFAULT_SPEC) -> DataFrame:
    """Failed rows stay in line as a blank object plus ``error`` and ``index``."""
    blank = F.struct(F.lit("").alias(spec.title_field),
                     *[F.array().cast("array<string>").alias(f) for f in spec.list_fields])
    return (df.withColumn("output", F.when(F.col("ok"), F.col("output")).otherwise(blank))
              .withColumn("error", F.when(~F.col("ok"), F.col("reason")))
              .withColumn("index", F.when(~F.col("ok"), F.col(idx))))


def pick_attempt(attempts: DataFrame, keys=("run", "idx"), attempt: str = "attempt",
                 ok: str = "ok") -> DataFrame:
    """Per key: the first successful attempt, else the last attempt.

    One aggregation: ``min_by`` over an ordering struct (success first by
    attempt number, then failures by descending attempt number).  The
    partial aggregate keeps one row per key and map task before the shuffle.
    """
    others = [c for c in attempts.columns if c not in keys]
    order = F.when(F.col(ok), F.struct(F.lit(0).alias("a"), F.col(attempt).alias("b"))) \
             .otherwise(F.struct(F.lit(1).alias("a"), (-F.col(attempt)).alias("b")))
    picked = (attempts.groupBy(*keys)
              .agg(F.min_by(F.struct(*[F.col(c) for c in others]), order).alias("_p"),
                   F.count(F.lit(1)).alias("n_attempts")))
    return picked.select(*keys, "_p.*", "n_attempts")
