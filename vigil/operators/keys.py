"""Dense surrogate keys without a global sort in one task.

``row_number() OVER (ORDER BY k)`` with no partition moves every row to one
task. Here the rows are range-partitioned on the key (sampled bounds, many
tasks), each task numbers its rows locally (``monotonically_increasing_id``
is consecutive inside a partition), and a per-partition count table --
exactly one row per partition, so its size is bounded by the partition
count -- gives each partition its starting offset. The numbered rows are
checkpointed once so offsets and rows always agree.
The result equals the global ``row_number`` (keys must be unique).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PID = "__pid"
_MID = "__mid"


def dense_key(df: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..n following ``order`` (use ``asc_nulls_last`` etc)."""
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id()))
    # Range bounds come from sampling; pin one numbering with a reliable
    # checkpoint (shared folder) so the count branch and the row branch
    # (and any retried task) see the same partition of every row.
    ensure_checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    # Inside partition p the ids are (p << 33) + 0, 1, 2, ...
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    sizes = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__cnt"))
    offsets = sizes.select(_PID, F.coalesce(F.sum("__cnt").over(
        Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    # offsets: one row per partition -> broadcast is size-bounded.
    return (ranged.join(F.broadcast(offsets), _PID)
            .withColumn(name, (F.col("__off") + local + 1).cast("long"))
            .drop(_PID, _MID, "__off"))
