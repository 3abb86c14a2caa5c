"""Marker-tagged text: records introduced by ``ID <n> -`` markers.

A record runs from its marker to the next one.  Markers stand at line starts by default; ``loose=True`` finds them
anywhere, also with the number on the next line, and so splits words such as "acid 5".  Records are cut inside
each file split and only those that cross splits are put together by a shuffle (``shapekit.sources.splits``), so a
large file spreads over many tasks and its text is not exchanged.  Record texts are stripped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapekit.functions.text import PY_WS, strip_ws
from shapekit.sources.splits import marked_records

# The marker shape (any case, optional leading "i"),
# and the dash characters that may follow the number.
MARKER = r"i?ID\s+\d+"
MARKER_HEAD = r"(?i)^i?ID\s+(\d+)"
DASHES = "[—-]*"
#: a marker at a line start, its white space on that line; a marker anywhere (patterns of the tasks)
ANCHORED = r"(?m)^[iI]?[iI][dD][^\S\n]+[0-9]+"
LOOSE = r"[iI]?[iI][dD]\s+[0-9]+"


def _head(space: str) -> str:
    return rf"\A[iI]?[iI][dD]{space}+([0-9]+)"


def read_tagged_text(spark: SparkSession, path: str, loose: bool = False) -> DataFrame:
    """(id, pos, text): one row per marker occurrence, in file order ``pos``."""
    found = marked_records(spark, path, LOOSE if loose else ANCHORED)
    space = PY_WS if loose else r"[\s&&[^\n]]"
    if loose:  # a marker whose parts lie in two splits is inside of the record that crosses them
        mark = rf"[iI]?[iI][dD]{PY_WS}+[0-9]+"
        parts = F.regexp_extract_all("value", F.lit(rf"(?s)((?:{mark})?+.*?)(?={mark}|\z)"), 1)
        found = found.select("file", "block", "n", F.posexplode(F.when(F.col("crossing"), parts).otherwise(F.array("value"))).alias("part", "value"))
    else:
        found = found.select("file", "block", "n", F.lit(0).alias("part"), "value")
    ident = F.regexp_extract("value", _head(space), 1).try_cast("bigint")
    body = F.regexp_replace("value", rf"{_head(space)}{space}*{DASHES}{space}*", "")
    return (found.select(ident.alias("id"), F.struct("file", "block", "n", "part").alias("pos"), strip_ws(body).alias("text"))
            .filter(F.col("id").isNotNull()))


def marker_audit(spark: SparkSession, path: str) -> DataFrame:
    """(n_lines, n_anchored, n_loose, n_disagree): markers at line starts, markers the unanchored rule
    finds, and lines on which the two differ (words such as "acid 5")."""
    line = spark.read.option("encoding", "UTF-8").text(path).select(
        F.rlike("value", F.lit(MARKER_HEAD)).cast("int").alias("a"), F.regexp_count("value", F.lit("(?i)" + MARKER)).alias("l"))
    return line.agg(F.count(F.lit(1)).alias("n_lines"), F.sum("a").cast("bigint").alias("n_anchored"),
                    F.sum("l").cast("bigint").alias("n_loose"), F.count_if(F.col("a") != F.col("l")).alias("n_disagree"))


def latest_per_key(df: DataFrame, key: str = "id", pos: str = "pos", value: str = "text") -> DataFrame:
    """Duplicate keys: the last occurrence wins (one aggregation, no window sort)."""
    return df.groupBy(key).agg(F.max_by(value, pos).alias(value))
