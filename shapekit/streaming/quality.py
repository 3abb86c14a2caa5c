"""Validate raw answers as they arrive; good and failed rows to a sink, counts per model.

An answer counts once: repeats of (run, idx) are dropped by the stream's state,
whichever micro-batch brings them.  Each micro-batch is validated once and written by
``foreachBatch`` to its own ``batch=<id>`` folders, so a batch replayed after a failure
rewrites the same rows.  Its counts are read from the rows just written and stored
beside them under the same id; running counts are the sum over batches, so no table
is ever replaced in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapekit.operators import validate as V

KEYS = ("run", "idx")


def validated_stream(stream: DataFrame, mode: str = V.STRICT, raw: str = "raw", keys=KEYS, ts: str | None = None,
                     delay: str = "1 day", outputs=None) -> DataFrame:
    """First answer per key, validated.  With an event time ``ts`` the keys are forgotten ``delay``
    after the watermark; without one they are kept for the life of the stream."""
    once = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys)) if ts else stream.dropDuplicates(list(keys))
    return V.validate(once, mode, raw, outputs=outputs)


def write_batches(out_dir: str, keys=KEYS, counts_dir: str | None = None, by=("model",)):
    """foreachBatch function: good / failed rows of a micro-batch, then their counts."""
    def replace(df: DataFrame, path: str, *parts: str):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)

    def fn(batch: DataFrame, batch_id: int):
        rows = (batch.dropDuplicates(list(keys)).withColumn("batch", F.lit(batch_id))
                .withColumn("status", F.when(F.col("ok"), "ok").otherwise("failed")))
        replace(rows, out_dir, "status", "batch")
        if counts_dir:
            written = batch.sparkSession.read.schema(rows.schema).parquet(out_dir).filter(F.col("batch") == batch_id)
            counts = written.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("extracted"),
                                              F.count_if(~F.col("ok")).alias("failures"))
            replace(counts.withColumn("batch", F.lit(batch_id)), counts_dir, "batch")
    return fn


def running_counts(spark: SparkSession, counts_dir: str, by=("model",)) -> DataFrame:
    """Counts over all batches stored so far."""
    return spark.read.parquet(counts_dir).groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("total", "extracted", "failures")))


def start_quality_stream(validated: DataFrame, out_dir: str, checkpoint: str, counts_dir: str | None = None,
                         available_now: bool = True, by=("model",)):
    """Start the stream; returns its query."""
    trig = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    return (validated.writeStream.foreachBatch(write_batches(out_dir, counts_dir=counts_dir, by=by))
            .option("checkpointLocation", checkpoint).trigger(**trig).start())
