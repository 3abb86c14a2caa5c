"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Duplicate JSON keys keep the last value, as
# Python's json loader does; AQE re-plans joins and coalesces partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # tolerant CSV reading judges each row on all of its cells
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shapekit", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shapekit`` importable in Python workers (``addPyFile`` of a zip).

    Needed by the Arrow/pandas stages (scoring, tokenizer UDF, stream state);
    on a cluster this is what ``--py-files`` does.  Once per SparkContext.
    """
    import shutil
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="shapekit-pyfiles-"), "shapekit")
    zpath = shutil.make_archive(base, "zip", root_dir=os.path.dirname(pkg), base_dir="shapekit")
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL settings that can change on a live session and ship the package."""
    ship_package(spark)
    for k in ("spark.sql.variant.allowDuplicateKeys", "spark.sql.session.timeZone",
              "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.csv.parser.columnPruning.enabled"):
        spark.conf.set(k, BASE_CONF[k])  # these decide results: a cluster that forbids one must say so


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may leave it unset: a folder of our own is chosen then.  On a
    cluster the executors would each write to their own disk, so it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="shapekit-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))
