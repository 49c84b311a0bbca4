"""Materialised tables shared by many queries, one set per input folder.

Each stage (raw landing view, scored, deduped, the nine star tables) is
written once as parquet under the cluster's shared ``spark.checkpoint.dir``
and read back. That cuts lineage (a lost executor re-reads files instead of
re-running window stages), keeps later plans small, and gives later scans
column pruning and filter pushdown. Nothing goes through the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..operators import dedup, features, rules, silver, star
from ..session import DEFAULT_CONF, scratch_path
from ..sources import fixtures

_CACHE: dict = {}


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared checkpoint folder; read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def scan_tasks(spark: SparkSession, n: int):
    """Scans that start inside are split into about ``n`` tasks, as far as the files' row groups allow."""
    key = "spark.sql.files.minPartitionNum"
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


class Catalog:
    """Lazily built, materialised stages for one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._t: dict = {}

    def _get(self, name, make):
        if name not in self._t:
            self._t[name] = materialize(make(), name)
        return self._t[name]

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name)

    def folder(self, name: str) -> str:
        """The folder that a stage was written to."""
        return self.table(name).inputFiles()[0].rsplit("/", 1)[0]

    def raw(self) -> DataFrame:
        # The landing table is written as many files (one per shuffle
        # partition) so that every later stage scans it with full parallelism.
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self._get("raw_txn", lambda: fixtures.raw_txn(self.spark, self.sf_dir, n))

    def silver(self) -> DataFrame:
        # Cleaning is the costliest step a byte: Spark would pack the landing files into one task a core.
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        with scan_tasks(self.spark, n):
            return self._get("silver", lambda: silver.build(self.raw()))

    def scored(self) -> DataFrame:
        return self._get("scored", lambda: rules.score(features.add(self.silver())))

    def deduped(self) -> DataFrame:
        return self._get("deduped", lambda: dedup.keep_first(self.scored()))

    def dims(self) -> dict:
        return {n: self.table(n) for n in star.DIMENSIONS}

    def table(self, name: str) -> DataFrame:
        if name in star.DIMENSIONS:
            return self._get(name, lambda: self._dimension(name))
        if name == "fact_transaction":
            return self._get(name, lambda: star.fact_transaction(self.deduped(), self.dims()))
        if name == "fact_alert":
            return self._get(name, lambda: star.fact_alert(self.deduped()))
        if name in ("raw_txn", "silver", "scored", "deduped"):
            return getattr(self, name if name != "raw_txn" else "raw")()
        raise KeyError(name)

    def _dimension(self, name: str) -> DataFrame:
        build = {
            "dim_date": lambda: star.dim_date(self.deduped()),
            "dim_time": lambda: star.dim_time(self.spark),
            "dim_customer": lambda: star.dim_customer(self.deduped()),
            "dim_merchant": lambda: star.dim_merchant(self.deduped()),
            "dim_channel": lambda: star.dim_channel(self.deduped()),
            "dim_card": lambda: star.dim_card(self.deduped()),
            "dim_risk_rule": lambda: star.dim_risk_rule(self.spark),
        }[name]
        df = build()
        return star.with_unknown(name, df) if name in star.UNKNOWN_MEMBERS else df

    def star(self) -> dict:
        """All nine tables. Those that only need the deduped rows are built side by side: each is a few small jobs, which alone
        would leave most of a cluster idle."""
        self.deduped()
        missing = [n for n in (*star.DIMENSIONS, "fact_alert") if n not in self._t]
        with ThreadPoolExecutor(max(1, len(missing))) as pool:
            for _ in pool.map(self.table, missing):
                pass
        return self.dims() | {n: self.table(n) for n in ("fact_transaction", "fact_alert")}


def get(spark: SparkSession, sf_dir: str) -> Catalog:
    # Naive source times are read as UTC: every derived hour and date must not
    # depend on where the job runs, whatever session the caller passes in.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", DEFAULT_CONF["spark.sql.codegen.hugeMethodLimit"])
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = Catalog(spark, sf_dir.rstrip("/"))
    return _CACHE[key]
