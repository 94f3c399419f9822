"""Execution helpers: durable materialisation and size-checked broadcasts.

* ``durable(df)`` cuts lineage with a reliable ``checkpoint()`` into the
  directory the cluster names in ``spark.checkpoint.dir``. Only a local
  session (tests, single-machine runs) gets a fresh scratch directory when
  the setting is absent; on a cluster the setting is required, because a
  machine-local folder would not survive the loss of an executor.
* ``stored(df, name)`` does the same with a table of its own, in compressed columns.
* ``bounded_broadcast(df, max_rows)`` counts a side that is *expected* to be
  small and only then marks it for broadcast; above the bound the plain
  DataFrame is returned and Spark plans a shuffle join (AQE can still demote
  it to a broadcast at run time, and splits skewed partitions).
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default ceiling for broadcasting a side that the caller believes is small.
DEFAULT_BROADCAST_ROWS = 2_000_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage (HDFS/S3/...) "
            "so materialised stages survive executor loss")
    # Single machine: its local disk is the shared storage.
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to reliable storage and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as compressed columns under the checkpoint directory and read back: for
    tables with many rows, of which a reader takes some columns."""
    return kept(df, name)[0]


def kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stored`` and its folder, for a caller that deletes it (``delete_folder``) when it is done."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing refers to any more: it does so when
    the driver's JVM collects its garbage, which a small driver with large shuffles may put off for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when its row count is within ``max_rows``."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def scalar_row(df: DataFrame) -> dict:
    """Collect a one-row aggregate (corpus statistics) as a dict."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected exactly one row, got {len(rows)}")
    return rows[0].asDict()


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _folder(spark, path)
    return int(fs.getContentSummary(p).getLength())


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return bool(fs.exists(p))


def table_version(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and times of a table's files: changes when it is rewritten."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return ()
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in Python workers (``addPyFile`` of a zip).

    Tasks that run Python (``mapInArrow``) unpickle functions of this
    package by reference, so executors need the package itself; on a cluster
    the zip travels through Spark's file server like ``--py-files``.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-pyfiles-"), "quarry.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
