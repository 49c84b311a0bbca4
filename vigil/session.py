"""Spark session with the settings every job in this package relies on.

* ``spark.sql.session.timeZone=UTC``: naive source times are read as UTC and
  every derived hour/date is independent of where the job runs.
* ANSI mode stays on (Spark 4 default); cleaners use ``try_*`` functions so a
  bad value becomes NULL instead of failing the job.
* AQE on, with skew-join splitting and partition coalescing, so joins whose
  sides are not size-bounded get re-planned from real shuffle statistics.
* The Spark UI is off: no server is started.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods beyond 8,000 bytes: projections that wide go without whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get(master: str | None = None, shuffle_partitions: int | None = None,
        app_name: str = "vigil", extra: dict | None = None,
        driver_memory: str | None = None) -> SparkSession:
    """Return (or create) the session with the package defaults applied.

    On a cluster ``master`` is left to spark-submit. Local tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the executor; size its heap.
        conf["spark.driver.memory"] = driver_memory or os.environ.get("VIGIL_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(k, conf[k])
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only a local session may do without: it gets a folder of its own,
    which goes when the process ends. Anywhere else each executor would write to its own disk, so that is an error."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="vigil-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, under the shared checkpoint folder so that it survives the loss of any
    one executor. ``drop_scratch`` deletes all of them."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vigil-tables/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables: for the end of a job, when its results have been written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigil-tables")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python, once an application: they need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_vigil_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="vigil-ship-")  # the driver serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = Path(folder) / "vigil.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._vigil_shipped = True
