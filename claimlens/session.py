"""Spark session and shared-folder helpers.

The library never picks a machine-local folder on a cluster: every place it
writes (tables, stream checkpoints, saved models) lives under the
directory the cluster names in ``spark.checkpoint.dir``.  Only with a local master
(tests, a laptop) and the setting unset does :func:`shared_dir` create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "claimlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, wherever they start (like ``--py-files``); once per application.

    A session that was built elsewhere needs this call, or the package on the workers' path.
    """
    sc = spark.sparkContext
    if getattr(sc, "_claimlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="claimlens-package-"), "claimlens.zip")  # the driver serves it to the executors
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if not name.endswith(".pyc"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("claimlens", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._claimlens_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for lineage cuts and written tables.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset, a local
    master gets a temporary folder (laptop, tests); a cluster is an error, since
    its executors would not see such a folder.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set as a runtime conf either
            configured = None
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a random sub-folder; use its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="claimlens-shared-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if (made := _SCOPE.get()) is not None:
        made.append(path)
    return path


_SCOPE: ContextVar[list[str] | None] = ContextVar("claimlens_written", default=None)


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Removes what :func:`write_table` and :func:`scratch_path` made inside the ``with`` block, also after an error.

    Results must be consumed (collected, written elsewhere) inside the block.  Without a scope the folders stay, because a lazy result
    may still read them.  Scopes nest: an inner one removes its own.
    """
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield made
    finally:
        _SCOPE.reset(token)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(hadoop).delete(where, True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor re-reads the files
    instead of replaying the plan) and keeps a columnar, prunable source.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
