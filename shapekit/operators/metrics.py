"""Quality metrics per model and phase: summaries, failure histograms, rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapekit.operators import validate as V

SYNTAX_FAILURES = ("no_json", "invalid_json")


def _rate(cond) -> F.Column:
    return F.round(F.avg(F.when(cond, 1.0).otherwise(0.0)), 6)


def extraction_summary(validated: DataFrame, by=("model", "phase")) -> DataFrame:
    """Extracted / total / failures per run ("Extracted n / N")."""
    return (validated.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("ok")).alias("extracted"),
                 F.count_if(~F.col("ok")).alias("failures")))


def failure_histogram(validated: DataFrame, by=("phase",)) -> DataFrame:
    """Count per failure reason; parser detail after ``:`` is cut off."""
    return (validated.filter(~F.col("ok"))
            .withColumn("reason", F.substring_index("reason", ":", 1))
            .groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n")))


def quality_rates(runs: DataFrame, verdicts: DataFrame | None = None, raw: str = "raw",
                  by=("model", "phase")) -> DataFrame:
    """Syntactic, schema and semantic rates per model x phase, both validators.

    The strict and lenient rules differ (exact key set vs aliases/defaults/type
    check), so both are reported side by side.  ``semantic_rate`` is the share
    of lenient-valid answers judged correct among those with a verdict.
    """
    lv = V.validate_reasons(runs.select(*by, "idx", raw), raw)
    if verdicts is not None:
        lv = lv.join(verdicts, "idx", "left")
    else:
        lv = lv.withColumn("semantic_ok", F.lit(None).cast("boolean"))
    syn = F.col("strict_reason").isNull() | ~F.col("strict_reason").isin(*SYNTAX_FAILURES)
    return (lv.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n"),
                 _rate(syn).alias("syntax_rate"),
                 _rate(F.col("strict_reason").isNull()).alias("strict_rate"),
                 _rate(F.col("lenient_reason").isNull()).alias("lenient_rate"),
                 F.round(F.avg(F.when(F.col("lenient_reason").isNull(),
                                      F.col("semantic_ok").cast("double"))), 6).alias("semantic_rate")))
