"""Writers: CSV with header, JSON lines with null fields kept, per-run append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header, no index column, UTF-8, doubled quotes inside quoted cells."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("encoding", "UTF-8").csv(path))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, non-ASCII kept as is, null fields written as null."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite", pretty: bool = False) -> None:
    """Each part file is one JSON array, the form of the scripts' result files; null fields kept.
    ``pretty`` spreads an element over indented lines."""
    options = {"ignoreNullFields": "false", "pretty": "true" if pretty else "false"}
    line = df.select(F.to_json(F.struct("*"), options).alias("value"))

    def wrap(batches):
        import pyarrow as pa
        lead = "["
        for batch in batches:
            rows = [lead + v if k == 0 else "," + v for k, v in enumerate(batch.column(0).to_pylist())]
            if rows:
                lead = ","
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "]"], pa.string())], names=["value"])
    line.mapInArrow(wrap, "value string").write.mode(mode).text(path)


def append_jsonl(df: DataFrame, path: str, run_id: str, reset: bool = False) -> None:
    """Append records under ``run_id=<id>``; ``reset`` replaces only that run.

    Dynamic partition overwrite clears the run's own folder and leaves other
    runs alone, which is the per-run "clear at start, then append" of a log.
    """
    out = df.withColumn("run_id", F.lit(run_id))
    w = out.write.partitionBy("run_id").option("ignoreNullFields", False)
    if reset:
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").json(path)
    else:
        w.mode("append").json(path)


def write_quarantine(validated: DataFrame, path: str, ok: str = "ok", mode: str = "overwrite") -> None:
    """Good and failed rows to sibling folders ``status=ok`` / ``status=failed`` in one job."""
    (validated.withColumn("status", F.when(F.col(ok), "ok").otherwise("failed"))
     .write.mode(mode).partitionBy("status").option("ignoreNullFields", False).json(path))
