"""Tolerant CSV reading: over-long rows are skipped, short rows kept with nulls.

The rule of the source scripts (a pandas reader skipping bad lines) is judged
per row, on the raw record.  Spark reads the wanted columns plus one sentinel column ``_extra``
and a corrupt-record column, in PERMISSIVE mode:

* a row exactly one cell too long parses cleanly against the wider schema,
  so its corrupt record is null -> ``too_long``;
* any other row is malformed against the wider schema, and its corrupt record holds the raw text.
  Its width is the number of separators outside quotes, so cells that are empty count too:
  more cells than columns -> ``too_long``;
* a quote that never closes makes the cells after it unreadable -> ``unterminated_quote``
  (or ``too_long``, where what follows reads as exactly one cell too many: set aside too);
* rows of the right width or shorter -> ``ok``, missing cells null.

Cells with quoted line breaks (``multi_line``) are read from splits as well: ``shapekit.sources.splits`` carries the
quote state over lines and splits and gives whole records to the same parser, so one large file is many tasks.

DROPMALFORMED is not usable: it also drops short rows.  CSV column pruning
would judge width against the pruned schema, so the session turns it off
(``spark.sql.csv.parser.columnPruning.enabled``) and rows are judged on all
columns.  Empty cells read as null; ``sanitize`` turns them back into "".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapekit.sources.splits import quoted_records

CORRUPT = "_corrupt"
EXTRA = "_extra"


def _schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, EXTRA, CORRUPT]])


OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"', "enforceSchema": "true"}


def _lines(spark: SparkSession, path: str, columns, header: bool) -> DataFrame:
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    return spark.read.schema(_schema(columns)).options(**OPTIONS).option("header", header).csv(path)


def _records(spark: SparkSession, path: str, columns, header: bool) -> DataFrame:
    """The same columns from records that may hold line breaks; the first record of a file is its header."""
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    found = quoted_records(spark, path).filter("value <> ''")
    if header:
        found = found.filter("block <> 0 OR n <> 1")
    names = ", ".join(f"`{c}` string" for c in [*columns, EXTRA, CORRUPT])
    return found.select(F.from_csv("value", names, OPTIONS).alias("r")).select("r.*")


def read_tolerant_csv_with_status(spark: SparkSession, path: str, columns, multi_line: bool = False,
                                  header: bool = True) -> DataFrame:
    """All rows with ``status`` ('ok', 'too_long' or 'unterminated_quote').

    ``multi_line`` allows quoted line breaks, at the price of two more scans of the file.  A quote that never
    closes then takes the lines up to the next quote, or the rest of the file.
    """
    df = (_records if multi_line else _lines)(spark, path, columns, header)
    bare = F.regexp_replace(CORRUPT, r'"(?:[^"]|"")*+"', "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    status = (F.when(F.contains(bare, F.lit('"')), "unterminated_quote")
              .when(F.col(CORRUPT).isNull() | F.col(EXTRA).isNotNull() | (cells > len(columns)), "too_long").otherwise("ok"))
    return df.select(*columns, status.alias("status"))


def audit_csv(spark: SparkSession, path: str, columns, multi_line: bool = False, header: bool = True) -> DataFrame:
    """(status, n): rows kept and rows rejected by cause."""
    return (read_tolerant_csv_with_status(spark, path, columns, multi_line, header)
            .groupBy("status").agg(F.count(F.lit(1)).alias("n")))


def read_tolerant_csv(spark: SparkSession, path: str, columns, multi_line: bool = False,
                      header: bool = True):
    """(good, bad): good rows with the wanted columns; bad rows with their status."""
    df = read_tolerant_csv_with_status(spark, path, columns, multi_line, header)
    good = df.filter(F.col("status") == "ok").select(*columns)
    bad = df.filter(F.col("status") != "ok")
    return good, bad


PAIR_COLUMNS = ("id", "text", "json")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Paired training CSV (id, text, json); texts may hold line breaks."""
    good, _ = read_tolerant_csv(spark, path, PAIR_COLUMNS, multi_line=True)
    return good.select(F.col("id").try_cast("bigint").alias("id"), "text", "json")


def read_csv_header(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header-named, all-string read (an empty header name becomes ``_c0``)."""
    return (spark.read.option("header", True).option("escape", '"')
            .option("multiLine", multi_line).option("inferSchema", False).csv(path))
